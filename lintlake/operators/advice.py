"""Advice runs: choose issues, attach replies, count.

The model is outside: prompts are written as a table, replies come back as a table
(issue_key, model, raw) with one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lintlake.functions.markup import advice_parts
from lintlake.operators.issues import best_row

# Name of the advice column at each depth.
ADVICE_COLUMN = {
    "issue": "copilot_advice",
    "block": "bug_block_advice",
    "callsite": "bug_callsite_advice",
}
NO_REPLY = "model_call_error: no reply"


def _descending_as_ascending(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [(-F.col(c) if desc else F.col(c)).alias(f"_o{i}") for i, (c, desc) in enumerate(order)]


def until_processed(
    df: DataFrame, stop_after: int, order: Sequence[tuple[str, bool]], ok: Column
) -> DataFrame:
    """Rows in order up to the `stop_after`-th row with `ok`; rows without it do not count.

    `order` lists (column, descending); descending columns are numeric. The cut-off is the
    order key of the N-th ok row, found by a top-k, and compared as a scalar subquery: no
    window over the whole table, no single task that sees every row.
    """
    key = F.struct(*_descending_as_ascending(order))
    keyed = df.withColumn("_key", key).withColumn("_ok", ok)
    best = keyed.where("_ok").select("_key").orderBy("_key").limit(stop_after)
    # Null while fewer than N ok rows exist: then nothing is cut off.
    last = best.agg(
        F.when(F.count("*") >= stop_after, F.max("_key")).alias("cut")
    ).scalar()
    return keyed.where(F.coalesce(F.col("_key") <= last, F.lit(True))).drop("_key", "_ok")


def attach_advice(
    prompts: DataFrame,
    replies: DataFrame,
    level: str,
    model: str,
    prompt_error: str | None = None,
    drop: Sequence[str] = ("blocks",),
) -> DataFrame:
    """Join replies by issue key and add the advice struct of the level.

    Archived runs may hold several replies of a key: the one of the newest run counts, or
    the last by model and text. So both sides have one row per issue, and no key is hot.
    A priority score is kept only with a good reply.

    `prompt_error` names a column that, where set, means the prompt could not be built.
    Context blocks are dropped, all else is kept; `advice_status` is ok, prompt_error or
    model_error.
    """
    newest = [F.col(c) for c in ("run_ts", "model", "raw") if c in replies.columns]
    joined = prompts.join(
        best_row(replies, ["issue_key"], newest, last=True).select(
            "issue_key", F.col("raw").alias("_raw_reply"), F.col("model").alias("_model")
        ),
        "issue_key",
        "left",
    )
    parts = advice_parts(F.col("_raw_reply"))
    broken = F.col(prompt_error) if prompt_error else F.lit(None).cast("string")
    status = (
        F.when(broken.isNotNull(), "prompt_error")
        .when(F.col("_raw_reply").isNull(), "model_error")
        .otherwise("ok")
    )
    ready = joined.withColumn("advice_status", status).withColumn("_parts", parts)
    good = F.col("advice_status") == "ok"
    advice = F.struct(
        F.coalesce("_model", F.lit(model)).alias("model"),
        F.when(good, F.col("_parts.explanation")).alias("explanation"),
        F.when(good, F.col("_parts.code_update")).alias("code_update"),
        F.when(good, F.col("_parts.raw")).alias("raw"),
        F.when(F.col("advice_status") == "prompt_error", F.concat(F.lit("prompt_build_error: "), broken))
        .when(F.col("advice_status") == "model_error", F.lit(NO_REPLY))
        .alias("error"),
    )
    if "priority_score" in prompts.columns:
        ready = ready.withColumn("priority_score", F.when(good, F.col("priority_score")))
    gone = [c for c in (*drop, prompt_error) if c and c in prompts.columns]
    return ready.withColumn(ADVICE_COLUMN[level], advice).drop(
        "_raw_reply", "_model", "_parts", *gone
    )


def _done() -> list[Column]:
    return [
        F.count_if(F.col("advice_status") != "prompt_error").alias("processed"),
        F.count("*").alias("written"),
        F.count_if(F.col("advice_status") != "ok").alias("errors"),
    ]


class RunCounters:
    """Counts a run while it is written: `get` after the write has the five counters.

    The counts come from the pass that writes (`DataFrame.observe`), so nothing runs twice.
    """

    def __init__(self) -> None:
        self._read, self._done = Observation(), Observation()

    def reading(self, records: DataFrame, in_window: Column) -> DataFrame:
        return records.observe(self._read, F.count("*").alias("read"), F.count_if(in_window).alias("filtered"))

    def writing(self, advised: DataFrame) -> DataFrame:
        return advised.observe(self._done, *_done())

    def get(self) -> dict[str, int]:
        return {**self._read.get, **self._done.get}


def run_counters(read: DataFrame, in_window: Column, written: DataFrame) -> DataFrame:
    """One row: read, filtered (`in_window` holds), processed, written, errors.

    For a run that is not written, such as a view; it computes the run once more. Where a
    run is written, `RunCounters` counts in the same pass.
    """
    seen = read.agg(F.struct(F.count("*").alias("n"), F.count_if(in_window).alias("m"))).scalar()
    done = written.agg(*_done())
    return done.select(
        seen["n"].alias("read"),
        seen["m"].alias("filtered"),
        "processed",
        "written",
        "errors",
    )
