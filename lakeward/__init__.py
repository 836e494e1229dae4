"""lakeward: a schema-contract gate for layered lakehouse tables on Spark.

Incoming batches are compared set-wise with versioned contracts, decided as a
whole (allow or quarantine), audited before any data write, and promoted to
the refined (silver) and published (gold) layers as Spark jobs over all
batches and feeds at once.
"""

from lakeward.operators.contracts import Contract, FieldContract, NoContractError
from lakeward.operators.tables import TableNames, approve, register_contracts
from lakeward.plans.gate import GateResult, gate_batches, release_gold, run_gated_release
from lakeward.sources.csv_batches import CsvFeed, observe_headers, observe_sidecars
from lakeward.sources.frames import FrameFeed, observe_frames

__version__ = "0.1.0"

__all__ = [
    "Contract", "FieldContract", "NoContractError", "TableNames", "approve", "register_contracts",
    "GateResult", "gate_batches", "release_gold", "run_gated_release",
    "CsvFeed", "observe_headers", "observe_sidecars", "FrameFeed", "observe_frames", "__version__",
]
