"""All tunables in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# They decide row contents, so they are part of the contract.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
DEFAULT_COLLECTION = "default"
TEST_COLLECTION = "test_collection"
DEFAULT_EXTENSIONS = (".py", ".sql", ".md", ".json", ".yaml")
EVAL_TOP_K = 5
MIN_HIT_RATE = 1.0
MIN_MRR = 0.90


@dataclass(frozen=True)
class EngineConfig:
    extensions: tuple[str, ...] = DEFAULT_EXTENSIONS
    collection: str = DEFAULT_COLLECTION
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
    top_k: int = 4
    fetch_k: int = 20
    mmr_lambda: float = 0.5
    # Largest question side that is shipped to every task; above it the
    # retrieval operators switch to a shuffled plan.
    broadcast_bytes: int = 64 << 20
    # Largest number of terms that may be broadcast with their frequencies.
    broadcast_terms: int = 1_000_000
    # Largest number of rows (ids, ranks and scores) broadcast into a join.
    broadcast_rows: int = 1_000_000
    # Rows per shuffled scoring cell (question block x document block).
    cell_rows: int = 50_000
    # Bytes of vectors per side of such a cell.
    cell_bytes: int = 64 << 20
    # Scoring tasks per core; each task sends its best rows of every question on.
    tasks_per_core: int = 4
    # Tasks of the repository reader; None = by the size of the files.
    read_partitions: int | None = None
