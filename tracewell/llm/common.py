"""What several text operators share: word splitting, label folds, shared storage, mixing of 64-bit hashes, workers' tables."""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import reduce, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.storage import shared_dir, stored

__all__ = ["bounded", "drop_tables", "held_out", "labelled_sample", "logistic", "mix64", "shared_dir", "stored", "tables_of_worker", "words"]

_TABLES: dict[tuple, object] = {}


def words(text: str | None) -> list[bytes]:
    """The maximal runs of [^\\x20\\x09-\\x0D] as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def drop_tables() -> None:
    """Frees what an earlier operator has left in this worker: workers outlive their tasks and serve one operator after the other."""
    if _TABLES:
        _TABLES.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def tables_of_worker(make: Callable) -> Callable:
    """make(*args), kept for later tasks of this worker until they ask for other tables: a worker holds one operator's at a time."""

    @wraps(make)
    def get(*args):
        key = (make.__module__, make.__qualname__, *args)
        if key not in _TABLES:
            drop_tables()
            _TABLES[key] = make(*args)
        return _TABLES[key]

    return get


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids that no model may learn from; null ids are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: dict[int, int]) -> DataFrame:
    """At most most[v] documents of each label value v, outside the held-out fifth: doc_id, text and label.

    The choice follows a hash of the id, so that reruns agree. Ids with contradictory labels count with the larger, ids
    with several texts with the last text in order. The chosen ids are at most sum(most.values()), which bounds the
    broadcast and the rows.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id", F.lit(7)), F.col("doc_id")]
    chosen = [rows.where(F.col("label") == v).orderBy(*order).limit(n) for v, n in most.items()]
    ids = reduce(DataFrame.unionByName, chosen)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("doc_id", "text", "label")


#: Rows larger than this part of a sample's bound come last, so that they take no other row's place.
LARGEST_SHARE = 64


def bounded(rows: DataFrame, size: str, most: int) -> DataFrame:
    """Of a labelled sample (stored, one row an id), the rows that come first by a hash of the id and have at most `most` in sum of size.

    Rows of more than most / LARGEST_SHARE come after all others, and those of more than most not at all, so a very large
    row changes nothing but itself.
    """
    order = Window.orderBy(F.col(size) > most // LARGEST_SHARE, F.xxhash64("doc_id", F.lit(7)), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fit = rows.where(F.col(size) <= most).select("doc_id", F.sum(size).over(order).alias("sum")).where(F.col("sum") <= most).select("doc_id")
    return rows.join(F.broadcast(fit), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton steps, both label values weighing the same."""
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    a = b = 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(share * (y - p) * x).sum() - decay * a, (share * (y - p)).sum()])
        w = share * p * (1 - p)
        h = np.array([[(w * x * x).sum() + decay, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
    return float(a), float(b)
