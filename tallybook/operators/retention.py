"""Storage tiers of event files by age."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class RetentionPolicy:
    """Ages in days; 0 switches the deep-archive or expiry step off."""

    archive: bool = True
    glacier_days: int = 90
    deep_archive_days: int = 365
    expire_days: int = 0

    def __post_init__(self):
        if self.glacier_days < 30:
            raise ValueError("glacier_days must be at least 30")
        if self.deep_archive_days != 0 and self.deep_archive_days < 180:
            raise ValueError("deep_archive_days must be 0 or at least 180")
        if self.expire_days < 0:
            raise ValueError("expire_days must be 0 or greater")


# --- fixed values: policy per environment --------------------------------------
POLICIES = {
    "dev": RetentionPolicy(archive=False, deep_archive_days=0, expire_days=30),
    "staging": RetentionPolicy(deep_archive_days=0),
    "prod": RetentionPolicy(),
}


def tier(age_days: Column, policy: RetentionPolicy) -> Column:
    """standard, glacier, deep_archive or expired."""
    ladder = F.when(F.lit(policy.expire_days > 0) & (age_days >= policy.expire_days), "expired")
    if policy.archive:
        if policy.deep_archive_days:
            ladder = ladder.when(age_days >= policy.deep_archive_days, "deep_archive")
        ladder = ladder.when(age_days >= policy.glacier_days, "glacier")
    return ladder.otherwise("standard")


def tier_counts(
    df: DataFrame,
    created: Column,
    as_of: Column,
    policies: Mapping[str, RetentionPolicy] = POLICIES,
) -> DataFrame:
    """Files per environment policy and tier on a day.

    Rows are first counted per age, so only one row per age meets the policies.
    """
    ages = df.groupBy(F.datediff(as_of, created).alias("age_days")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_policy = F.array(
        *[
            F.struct(F.lit(env).alias("environment"), tier(F.col("age_days"), p).alias("tier"))
            for env, p in policies.items()
        ]
    )
    return (
        ages.select("n", F.inline(per_policy))
        .groupBy("environment", "tier")
        .agg(F.sum("n").cast("bigint").alias("files"))
    )
