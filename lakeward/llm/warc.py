"""WARC archives: writing one record per page, and reading archives back by
boundary-chain verification.

Writing. Spark's text writer makes the archive files: a row is the record's
headers and payload, the row separator is the record's closing CR LF CR LF.
Commits, retries and parallel files are Spark's own. Of records whose equal
payload has at least ``min_bytes`` bytes, the one with the largest page_id
is the response that holds it; the others are revisit records without a
body, which name that response and carry the payload's digest and length.

Reading. The files are split at the magic ``WARC/1.1 CR LF`` by Spark's text
reader, which splits a large file over many tasks and reads any store that
Spark reads. Each row is a candidate record: the running sum of lengths
gives its offset, and its Content-Length the offset of its successor. A
magic inside a payload makes a false candidate. Pointer jumping from the
start of each file (the jump lengths double with every round) keeps the
candidates on the chain; the others are rejected and their bytes belong to
the payload of the record before them. A file whose chain does not end at
its last byte raises.

Edge cases. A null html is an empty payload; a null url is left out of the
headers; a null page_id gives a record without an id (it is never referred
to and revisits nothing). Repeated rows with the largest page_id of a
payload are all responses. Control characters in a url are percent-encoded.
An empty table gives no records. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm.common import cut, fresh_path, table, take

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
MIN_BYTES = 1000
RECORDS_PER_FILE = 4096
SALTS = 64


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, digest, refers_to of the records that revisit another: the
    copies are counted by digest on light rows (partial sums first), and the
    join back deals a frequent digest over ``SALTS`` keys."""
    light = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"),
                         F.octet_length("html").alias("n")).filter((F.col("n") >= min_bytes) & F.col("page_id").isNotNull())
    light = light.select("page_id", "digest").distinct()
    groups = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
    groups = groups.filter("copies > 1").select(F.col("digest").alias("g_digest"), "refers_to",
                                                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"))
    salted = light.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("salt") == F.col("g_salt")))
    return found.filter("page_id < refers_to").select("page_id", "digest", "refers_to")


def record(payload: Column, digest: Column, refers_to: Column, page_id: Column, url: Column) -> Column:
    """The text of a record from after its magic to before its closing lines."""
    safe_url = F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20")
    is_revisit = refers_to.isNotNull()
    n = F.octet_length(payload).cast("string")
    return F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        F.when(page_id.isNotNull(), F.concat(F.lit("WARC-Record-ID: <urn:page:"), page_id.cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), safe_url, F.lit("\r\n"))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), digest, F.lit("\r\nX-Payload-Length: "), n, F.lit("\r\n"),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.lit("Content-Type: text/html\r\nContent-Length: "), F.when(is_revisit, "0").otherwise(n), F.lit(END),
        F.when(is_revisit, "").otherwise(payload))


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files in the folder ``path``."""
    pages = take(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    # a written table has a size that the planner knows: few revisits are broadcast and the payloads stay where they are
    known = cut(revisits(pages, min_bytes), "warc-revisits")
    known = known.select(F.col("page_id").alias("r_page_id"), F.col("digest").alias("r_digest"), "refers_to")
    rows = pages.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    rows = rows.join(known, (F.col("page_id") == F.col("r_page_id")) & (F.col("digest") == F.col("r_digest")), "left")
    rows = rows.select(record(F.col("html"), F.col("digest"), F.col("refers_to"), F.col("page_id"), F.col("url")).alias("value"))
    rows.write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per magic in the files: file, at (offset of the magic), next
    (offset after the record that starts there by its own headers; null if
    they cannot be read), size of the row's bytes, and the bytes after the
    magic."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), F.octet_length("value").cast("long").alias("size"),
        F.col("_metadata.file_size").alias("file_size"), "value")
    raw = raw.withColumn("head_size", F.octet_length(F.substring_index("value", END, 1)) + F.lit(len(END)))
    length = F.regexp_extract(F.substring_index("value", END, 1), r"(?:^|\r\n)Content-Length: (\d{1,18})(?:\r\n|$)", 1)
    return raw.withColumn("length", F.when(length != "", length.cast("long")))


def chains(found: DataFrame) -> DataFrame:
    """Offsets of the candidates: file, row, at, next, file_size, split."""
    m = F.lit(len(MAGIC))
    inside = W.partitionBy("file", "split").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    light = found.select("file", "split", "row", "size", "file_size", "head_size", "length")
    sums = light.groupBy("file", "split").agg(F.sum(F.col("size") + m).alias("bytes"))
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("file").alias("b_file"), F.col("split").alias("b_split"),
                       F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    light = light.withColumn("within", F.coalesce(F.sum(F.col("size") + m).over(inside), F.lit(0)))
    light = light.join(sums, (F.col("file") == F.col("b_file")) & (F.col("split") == F.col("b_split")))
    # a row starts after the magic that closed the row before it; the first row of a file has none
    start = F.col("base") + F.col("within")
    return light.select("file", "row", "file_size", (start - m).alias("at"),
                        (start + F.col("head_size") + F.col("length") + F.lit(len(END))).alias("next"), "size")


def reachable(links: DataFrame) -> DataFrame:
    """Of candidates (file, at, next): file, at of those on the chain that
    starts at offset 0 of their file, by pointer jumping. Round k joins the
    jumps of length 2**k with themselves, so a chain of n records takes
    about log2(n) rounds; each round is a written table."""
    jumps = cut(links.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("on")), "warc-jumps")
    while True:
        ahead = jumps.select(F.col("file").alias("a_file"), F.col("at").alias("a_at"), F.col("to").alias("a_to"))
        hit = jumps.filter("`on`").select(F.col("file").alias("h_file"), F.col("to").alias("h_at"), F.lit(True).alias("hit")).distinct()
        step = jumps.join(ahead, (F.col("file") == F.col("a_file")) & (F.col("to") == F.col("a_at")), "left")
        step = step.join(hit, (F.col("file") == F.col("h_file")) & (F.col("at") == F.col("h_at")), "left")
        jumps = cut(step.select("file", "at", F.col("a_to").alias("to"), (F.col("on") | F.col("hit").isNotNull()).alias("on")), "warc-jumps")
        if jumps.filter("`on` and `to` is not null").isEmpty():
            return jumps.filter("`on`").select("file", "at")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files in ``path``: file, at, head (header
    text), payload (bytes)."""
    found = candidates(spark, path)
    links = cut(chains(found), "warc-links")
    real = links.filter("at >= 0")
    on = reachable(real).select(F.col("file").alias("o_file"), F.col("at").alias("o_at"))
    marked = links.join(on, (F.col("file") == F.col("o_file")) & (F.col("at") == F.col("o_at")), "left")
    marked = cut(marked.select("file", "row", "at", "next", "file_size", F.col("o_at").isNotNull().alias("kept")), "warc-marked")
    tails = marked.filter("kept").groupBy("file", "file_size").agg(F.max("next").alias("end"))
    broken = tails.filter(F.col("end").isNull() | (F.col("end") != F.col("file_size"))).select("file")
    first = broken.first()
    if first is not None:
        raise ValueError(f"{broken.count()} WARC files have a broken record chain, {first[0]} among them")
    # a rejected candidate is part of the record that holds its offset
    kept = marked.filter("kept").select("file", "row", "at", "next")
    rejected = marked.filter("not kept and at >= 0").select("file", "row", "at")
    outer = W.partitionBy("file").orderBy("at")
    rows = found.select("file", "row", "head_size", "length", "value")
    if rejected.isEmpty():
        rows = rows.join(kept.select(F.col("row").alias("k_row"), "at"), F.col("row") == F.col("k_row"))
        body = F.col("value")
    else:
        hit_files = rejected.select("file").distinct()
        owned = marked.filter("at >= 0").join(hit_files, "file", "left_semi")
        owned = owned.withColumn("owner", F.last(F.when(F.col("kept"), F.col("at")), True).over(outer))
        parts = owned.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1")
        owned = owned.join(parts, ["file", "owner"], "left_semi").select(F.col("row").alias("w_row"), "owner", "at")
        whole = rows.join(owned, F.col("row") == F.col("w_row")).groupBy("file", "owner").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda r: r["value"]), MAGIC).alias("whole"))
        whole = whole.select(F.col("file").alias("j_file"), F.col("owner").alias("j_at"), "whole")
        rows = rows.join(kept.select(F.col("row").alias("k_row"), "at"), F.col("row") == F.col("k_row"))
        rows = rows.join(whole, (F.col("file") == F.col("j_file")) & (F.col("at") == F.col("j_at")), "left")
        body = F.coalesce("whole", "value")
    data = body.cast("binary")
    return rows.select("file", "at", F.substring_index("value", END, 1).alias("head"),
                       F.substring(data, F.col("head_size") + 1, F.col("length").cast("int")).alias("payload"))


def header(head: Column, name: str) -> Column:
    got = F.regexp_extract(head, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(got != "", got)


def page_records(records: DataFrame) -> DataFrame:
    """One row per record as the archive tells it. The length and digest of
    a response are taken from the payload read; those of a revisit, which
    has no body, from its headers."""
    h = F.col("head")
    page = F.regexp_extract(h, r"WARC-Record-ID: <urn:page:(-?\d+)>", 1)
    refers = F.regexp_extract(h, r"WARC-Refers-To: <urn:page:(-?\d+)>", 1)
    kind = header(h, "WARC-Type")
    of_revisit = kind == "revisit"
    return records.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.when(of_revisit, header(h, "X-Payload-Length").cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(of_revisit, F.regexp_replace(header(h, "WARC-Payload-Digest"), "^sha1:", "")).otherwise(F.sha1("payload")).alias("payload_digest"),
        kind.alias("record_type"), F.when(refers != "", refers.cast("long")).alias("refers_to"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path))


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT h, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY h)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN d.page_id < g.top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id < g.top THEN g.top END AS refers_to
FROM d LEFT JOIN g ON d.h = g.h AND d.n >= 1000
"""
