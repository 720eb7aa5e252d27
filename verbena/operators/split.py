"""W2 stratified_split: repeatable train / val / test with exact per-stratum quotas.

Inside each stratum rows are ordered by ``md5('seed:id')`` then ``id`` (the
same order in Spark and in SQL engines), and the first ``quota`` rows go to
test, the next to val, the rest to train.  Quotas are integers, rounded half
up: ``test_n = round(n * test)``, ``val_n = round((n - test_n) * val / (1 - test))``.

The rank inside a stratum comes from ``row_index`` with ``group_by``: a
global range sort on ``(stratum, md5)``, so a stratum holding a third of all
rows is spread over many tasks; no window partitioned by stratum (which would
put a whole stratum in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .index import row_index

SCALE = 10_000  # fractions are applied in integer arithmetic, 4 decimals


def _frac(x: float) -> int:
    v = round(x * SCALE)
    if not 0 <= v < SCALE:
        raise ValueError("fractions must be in [0, 1)")
    return v


def _missing(strata: Sequence[str]):
    out = F.lit(False)
    for s in strata:
        out = out | F.col(s).isNull()
    return out


def order_key(key: str, seed: int = 42):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_split(df: DataFrame, key: str = "id", test: float = 0.15, val: float = 0.15,
               seed: int = 42, split_col: str = "split", strata: Sequence[str] = ()) -> DataFrame:
    """``mode='hash'``: one pass, no sort, no shuffle.

    Each row's ``md5('seed:id')`` is read as a uniform number in [0, 1):
    below ``test`` is test, below ``test + val`` is val, the rest train.  Every
    stratum gets the shares in expectation (not exactly); the same id always
    lands in the same part, whatever else is in the table.  A row with a null
    in ``strata`` gets a null split, as in the exact mode (D11).
    """
    u = F.conv(F.substring(order_key(key, seed), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    return df.withColumn(split_col, F.when(_missing(strata), F.lit(None).cast("string")).when(u < test, "test").when(u < test + val, "val")
                         .otherwise("train"))


def stratified_split(df: DataFrame, strata: Sequence[str], key: str = "id",
                     test: float = 0.15, val: float = 0.15, seed: int = 42,
                     split_col: str = "split", num_partitions: int | None = None,
                     mode: str = "exact") -> DataFrame:
    """Add ``split`` in ``train``/``val``/``test``.

    ``test=0`` gives a two-way train / val split (the sentiment variant:
    ``test=0, val=0.1``).  Rows with a null stratum get a null split (D11),
    they are kept, not dropped.  One read of the input: the stratum sizes come
    from the row index's own per-partition counts.  ``mode='hash'`` trades the
    exact quotas for a single pass without any sort (``hash_split``).
    """
    if mode == "hash":
        return hash_split(df, key, test, val, seed, split_col, strata)
    if mode != "exact":
        raise ValueError("mode must be 'exact' or 'hash'")
    strata = list(strata)
    t, v = _frac(test), _frac(val)
    ranked = row_index(df, [order_key(key, seed), F.col(key)], "__vb_rank", group_by=strata,
                       num_partitions=num_partitions, group_size="__vb_n")
    # quotas are arithmetic on the stratum size carried by every row: no join
    n = F.col("__vb_n")
    test_n = F.floor((n * t + SCALE // 2) / SCALE) if t else F.lit(0)
    rest = n - test_n
    if v:
        val_n = F.floor((rest * (2 * v) + (SCALE - t)) / (2 * (SCALE - t)))
    else:
        val_n = F.lit(0)
    rk = F.col("__vb_rank")
    split = (F.when(_missing(strata), F.lit(None).cast("string"))
             .when(rk < test_n, "test").when(rk < test_n + val_n, "val").otherwise("train"))
    return ranked.withColumn(split_col, split).drop("__vb_rank", "__vb_n")
