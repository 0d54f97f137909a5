"""Row-wise annotation by a model behind a small interface: batches, retries, checks and resume."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alinea.workspace import materialize

#: Takes a batch of records (dicts with a ``key``) and returns the reply per key.
Backend = Callable[[Sequence[dict]], dict[str, object]]


class ContractError(ValueError):
    """A reply that breaks the agreed form; the batch is tried again."""


def check_reply(reply: object, keys: Sequence[str]) -> dict[str, object]:
    """The reply if it is an object with all keys."""
    if not isinstance(reply, dict):
        raise ContractError("the reply is no object")
    missing = [k for k in keys if k not in reply]
    if missing:
        raise ContractError(f"the reply lacks {missing[:3]}")
    return {k: reply[k] for k in keys}


def check_tier(reply: object, candidates: int) -> tuple[str, int | None]:
    """Tier and candidate number of one match decision; an index out of range or none means no match."""
    tiers = ("merge", "link_regional", "link", "none")
    if not isinstance(reply, dict) or reply.get("tier") not in tiers:
        raise ContractError("unknown tier")
    at = reply.get("cc_idx")
    if reply["tier"] == "none" or not isinstance(at, int) or not 0 <= at < candidates:
        return "none", None
    return reply["tier"], at


def with_retry(call: Callable[[], object], attempts: int = 5, least: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """The call's result; failures wait twice as long each time, and the last one is raised."""
    for n in range(attempts):
        try:
            return call()
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(min(most, least * 2**n))


def numbered_batches(df: DataFrame, part: str, order: str, size: int) -> DataFrame:
    """``df`` with ``batch``: rows of one part in order, ``size`` to a batch, none across parts.

    Rows are spread by ranges of part and order, numbered within their range, and moved on by the
    counts of the ranges before, so that a part that holds most rows is numbered by many tasks. A
    null part is a part; ``order`` should be unique, else ties are numbered in any order.
    """
    spread = materialize(df.repartitionByRange(part, order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy(F.col(part).alias("_part"), "_range").agg(F.count("*").alias("_n"))
    counts = counts.select("_part", F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = spread.withColumn("_no", F.row_number().over(Window.partitionBy("_range", part).orderBy(order)))
    joined = here.join(counts, (F.col("_range") == F.col("_r")) & F.col(part).eqNullSafe(F.col("_part")))
    batch = F.floor((F.col("_before") + F.col("_no") - 1) / size).cast("int")
    return joined.withColumn("batch", batch).select(*df.columns, "batch")


def todo(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def annotate(df: DataFrame, key: str, fields: Sequence[str], backend: Backend, batch_size: int = 20, attempts: int = 5, wait: float = 2.0) -> DataFrame:
    """(key, reply as JSON text, error) for each row, asked in batches inside the tasks.

    Batches are formed per partition, so concurrency is the number of partitions. A batch that fails
    after all attempts gives its rows an error and no reply: they stay to do and a later run asks
    again. Null keys are left out.
    """
    import json

    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                keys = [str(k) for k in part[key]]
                records = [{"key": k} | {f: getattr(row, f) for f in fields} for k, row in zip(keys, part.itertuples(index=False))]
                try:
                    reply = with_retry(lambda: check_reply(backend(records), keys), attempts, wait)
                    out = [(k, json.dumps(reply[s], ensure_ascii=False), None) for k, s in zip(part[key], keys)]
                except Exception as e:
                    out = [(k, None, str(e)[:200]) for k in part[key]]
                yield pd.DataFrame(out, columns=[key, "reply", "error"])

    return df.filter(F.col(key).isNotNull()).select(key, *fields).mapInPandas(run, f"{key} {kind}, reply string, error string")


def fill(template: str, **values: Column) -> Column:
    """A prompt: the template with columns in place of its {names}; a null value gives a null prompt."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)))


def replay_backend(recorded: dict[str, object]) -> Backend:
    """Replies from a record, for tests and reruns without a model."""
    return lambda batch: {r["key"]: recorded[r["key"]] for r in batch if r["key"] in recorded}
