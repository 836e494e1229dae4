"""Sources: how batches and their observed schemas are read."""
