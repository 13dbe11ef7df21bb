"""Batch scoring of calls with a pluggable scorer, and its summaries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import prompts as P
from parley.functions import vocabulary as V
from parley.functions.answers import problem
from parley.functions.responses import check_responses
from parley.functions.rules import rule_insight
from parley.operators.scan import exact_percentiles

#: Takes prompts and gives an answer for each, in order; an exception in place of an answer fails that call alone.
Scorer = Callable[[list[str]], Sequence["str | Exception | None"]]
#: Prompts that are sent to the scorer at a time.
PROMPTS_SENT = 64
_OUTCOME = "answer string, attempts int, seconds double, exception string"


def _ask(scorer: Scorer, prompts: list[str]) -> tuple[list[str | Exception | None], float]:
    """Answers of one round and its seconds. If the scorer itself fails, so does every call of the round."""
    start = time.perf_counter()
    try:
        answers = list(scorer(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
    except Exception as exc:  # a failing call is data, not a reason to lose the batch
        answers = [exc] * len(prompts)
    return answers, time.perf_counter() - start


def _settled(scorer: Scorer, prompts: list[str], max_attempts: int) -> list[tuple]:
    """(answer, attempts, seconds, exception) of each prompt; only the open ones are asked again."""
    out: list[tuple] = [(None, max_attempts, 0.0, None)] * len(prompts)
    failed: dict[int, str] = {}
    queue = list(enumerate(prompts))
    for attempt in range(1, max_attempts + 1):
        answers, seconds = _ask(scorer, [text for _, text in queue])
        again = []
        for (i, _), answer in zip(queue, answers, strict=True):
            if answer is None or isinstance(answer, Exception):
                failed[i] = str(answer) if answer is not None else "no answer"
                again.append((i, prompts[i]))
                continue
            reason = problem(answer)
            if reason is None:
                out[i] = (answer, attempt, seconds, None)
            else:
                again.append((i, P.retry_text(prompts[i], answer, V.INVALID_REASON)))
        queue = again
        if not queue:
            break
    return [(*x[:3], failed.get(i)) for i, x in enumerate(out)]


def _outcomes(scorer: Scorer, max_attempts: int, prompts_sent: int) -> Callable[[Column], Column]:
    @F.pandas_udf(_OUTCOME)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in range(0, len(batch), prompts_sent):
                rows += _settled(scorer, batch.iloc[at : at + prompts_sent].tolist(), max_attempts)
            yield pd.DataFrame(rows, columns=["answer", "attempts", "seconds", "exception"])

    # A scorer is a remote model as a rule: it must run once per attempt, so the optimizer may
    # neither repeat nor merge it.
    return score.asNondeterministic()


def score_calls(
    calls: DataFrame, scorer: Scorer, max_attempts: int = V.MAX_ATTEMPTS, prompts_sent: int = PROMPTS_SENT
) -> DataFrame:
    """Score every call with up to ``max_attempts`` tries; no shuffle, and one Python node that sees prompts alone.

    A task keeps a queue of the open prompts of a batch and sends them ``prompts_sent`` at a time. A refused answer
    is quoted in the next prompt together with the reason; after an exception the plain prompt is sent again.
    Every read of the result calls the scorer again, so write it first, as ``score_to_table`` does.
    Adds ``insight, attempts, latency_seconds, success, error, last_exception, fallback_used, response``;
    the latency is that of the round in which the answer came.
    """
    asked = calls.withColumn("__prompt", P.short_prompt(F.col("transcript")))
    asked = asked.withColumn("__got", _outcomes(scorer, max_attempts, prompts_sent)(F.col("__prompt")))
    # a generated row is a border for the optimizer, which else evaluates the checks once per column
    row = F.inline(F.array(F.struct(*[F.col("__got")[c].alias(f"__{c}") for c in ("answer", "attempts", "seconds", "exception")])))
    checked = check_responses(asked.select(*calls.columns, row), "__answer", prefix="__c_")
    success = F.col("__c_valid")
    return checked.select(
        *calls.columns,
        F.col("__c_insight").alias("insight"),
        F.col("__attempts").alias("attempts"),
        F.when(success, F.round("__seconds", 4)).otherwise(0.0).alias("latency_seconds"),
        success.alias("success"),
        F.when(~success, V.EXHAUSTED_REASON).otherwise("").alias("error"),
        F.col("__exception").alias("last_exception"),
        (~success).alias("fallback_used"),
        F.when(success, F.col("__answer")).otherwise(V.FALLBACK_RESPONSE).alias("response"),
    )


def score_by_rules(calls: DataFrame) -> DataFrame:
    """The same output without any scorer: the keyword rules answer in the JVM, at the first try."""
    scored = calls.withColumn("insight", rule_insight(F.col("transcript")))
    return scored.withColumns(
        {
            "attempts": F.lit(1),
            "latency_seconds": F.lit(0.0),
            "success": F.lit(True),
            "error": F.lit(""),
            "last_exception": F.lit(None).cast("string"),
            "fallback_used": F.lit(False),
            "response": F.to_json("insight"),
        }
    )


def score_to_table(
    calls: DataFrame, path: str, run_date: str, scorer: Scorer | None = None, keep: Sequence[str] = (), **options: int
) -> DataFrame:
    """Scored calls of a day as a table, partitioned by ``run_date`` and read back: the scorer runs once.

    ``keep`` names the columns of ``calls`` that stay; the transcript is not stored again unless it is named. A
    re-run replaces its own date. Without a scorer the keyword rules answer.
    """
    scored = score_by_rules(calls) if scorer is None else score_calls(calls, scorer, **options)
    names = [*keep, "insight", "attempts", "latency_seconds", "success", "error", "last_exception", "fallback_used", "response"]
    dated = scored.select(*names, F.lit(run_date).cast("date").alias("run_date"))
    dated.write.partitionBy("run_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return calls.sparkSession.read.schema(dated.schema).parquet(path).where(F.col("run_date") == F.lit(run_date).cast("date"))


def with_fallback(df: DataFrame, response: Column, failed: Column, fallback: str = V.FALLBACK_RESPONSE) -> DataFrame:
    """Answer served to the caller, and whether it is the fallback."""
    return df.withColumn("fallback_used", failed).withColumn(
        "response", F.when(failed, F.lit(fallback)).otherwise(response)
    )


def batch_result(scored: DataFrame, point: float = 0.95) -> DataFrame:
    """Total, processed, failed, quality rate, mean and percentile latency of the processed calls."""
    good = F.when(F.col("success"), F.col("latency_seconds"))
    mark = exact_percentiles(scored.where("success"), "latency_seconds", [], [point]).select("value").scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("processed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.avg(F.col("success").cast("int")), F.lit(0.0)).alias("data_quality_rate"),
        F.coalesce(F.avg(good), F.lit(0.0)).alias("mean_latency_seconds"),
    ).withColumn("p95_latency_seconds", F.coalesce(mark, F.lit(0.0)))


def _top_values(df: DataFrame, values: Column, top: int) -> Column:
    """The most frequent list entries as an array of at most ``top`` texts."""
    leaders = (
        df.select(F.explode(values).alias("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("v"))
        .limit(top)
    )
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))))
    return leaders.agg(F.transform(ordered, lambda s: s["v"]).alias("top")).scalar()


def batch_summary(scored: DataFrame, top: int = 5, urgent: Sequence[str] = ("high",)) -> DataFrame:
    """One-row summary of a day's batch."""
    call = F.col("insight.callAnalysis")
    done = F.greatest(F.count_if("success"), F.lit(1))

    def share(test: Column) -> Column:
        return F.count_if(F.col("success") & test) * 100.0 / done

    mark = exact_percentiles(scored.where("success"), "latency_seconds", [], [0.95]).select("value").scalar()
    processed = scored.where("success")
    return scored.agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if("success").alias("processed_calls"),
        F.count_if(~F.col("success")).alias("failed_calls"),
        F.coalesce(F.avg(F.col("success").cast("int")), F.lit(0.0)).alias("data_quality_rate"),
        share(call["overallSentiment"] == "positive").alias("positive_sentiment_pct"),
        share(call["overallSentiment"] == "negative").alias("negative_sentiment_pct"),
        share(call["urgencyLevel"].isin(*urgent)).alias("high_urgency_pct"),
        F.coalesce(F.avg(F.when(F.col("success"), F.col("latency_seconds"))), F.lit(0.0)).alias(
            "avg_processing_seconds"
        ),
    ).withColumns(
        {
            "p95_latency_seconds": F.coalesce(mark, F.lit(0.0)),
            "top_topics": _top_values(processed, call["primaryTopics"], top),
            "top_complaints": _top_values(processed, F.col("insight.complaintAnalysis.complaintKeywords"), top),
        }
    )
