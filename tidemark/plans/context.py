"""Figures of a market as a whole by closed bucket: admissions, and what became of those admitted an hour or two before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, micros, ratio


def cohort_figures(lifecycle: DataFrame, width: int = 300, youngest: int = 3600, oldest: int = 7200) -> DataFrame:
    """bucket_end, admitted_tokens, active_transitions, mature_cohort_tokens, mature_cohort_active_tokens and their fraction, for each bucket with any.

    lifecycle: token_id, decided_at, new_state. The cohort of a bucket is the tokens that became NEW from `oldest`
    to `youngest` seconds before its end; active are those of them that were ACTIVE at any time before it. Each admission is laid out over the few
    buckets that it matters to, so neither side is compared with all of the other."""
    step = width * MICROS
    t = micros("decided_at")
    end_of = (F.floor(t / step) * step + step).alias("end")
    states = lifecycle.select("token_id", "new_state", t.alias("t"), end_of)
    in_bucket = states.groupBy("end").agg(F.count_if(F.col("new_state") == "NEW").alias("admitted_tokens"),
        F.count_if(F.col("new_state") == "ACTIVE").alias("active_transitions"))
    first = F.floor((F.col("t") + youngest * MICROS) / step) * step + step
    last = F.floor((F.col("t") + oldest * MICROS) / step) * step
    cohort = states.filter("new_state = 'NEW'").select("token_id", F.explode(F.sequence(first, last, F.lit(step))).alias("end")).distinct()
    active = states.filter("new_state = 'ACTIVE'").groupBy("token_id").agg(F.min("t").alias("active_at"))
    mature = cohort.join(active, "token_id", "left").groupBy("end").agg(F.count(F.lit(1)).alias("mature_cohort_tokens"),
        F.count_if(F.col("active_at") < F.col("end")).alias("mature_cohort_active_tokens"))
    both = reduce(lambda a, b: a.join(b, "end", "full"), [in_bucket, mature]).fillna(0)
    return both.select(
        F.timestamp_micros("end").cast("timestamp_ntz").alias("bucket_end"), "admitted_tokens", "active_transitions", "mature_cohort_tokens",
        "mature_cohort_active_tokens",
        ratio("mature_cohort_active_tokens", "mature_cohort_tokens").alias("mature_cohort_active_fraction"),
    )
