"""Verdicts against the ground truth of injected faults."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fault classes and the rule that has to catch each.
CLASS_RULES = {"malformed": "R1", "out-of-range": "R2", "duplicate": "R3", "out-of-order": "R4"}
DRAWS, SEED = 10_000, 42


@dataclass(frozen=True)
class Estimate:
    """A proportion with its bootstrap interval; undefined where there was nothing to count."""

    point: float | None
    ci_low: float | None
    ci_high: float | None
    n: int

    @property
    def defined(self) -> bool:
        return self.n > 0

    def __str__(self) -> str:
        return f"{self.point:.4f} [{self.ci_low:.4f}, {self.ci_high:.4f}]" if self.defined else "n/a (n=0)"

    def as_dict(self) -> dict:
        return {k: round(v, 6) if isinstance(v, float) else v for k, v in asdict(self).items()}


def proportion(k: int, n: int, draws: int = DRAWS, seed: int = SEED) -> Estimate:
    """Percentile bootstrap of k in n. Resampling n yes-no outcomes is one binomial draw, so its cost does not grow with n."""
    if n <= 0:
        return Estimate(None, None, None, 0)
    if not 0 <= k <= n:
        raise ValueError("k must be within 0 and n")
    import numpy as np

    sampled = np.random.default_rng(seed).binomial(n, k / n, draws) / n
    low, high = np.percentile(sampled, [2.5, 97.5])
    return Estimate(k / n, float(low), float(high), n)


def labelled(verdicts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Verdicts with what the manifest knows of them."""
    truth = manifest.select(F.col("index").alias("seq"), "fault_class", "is_fault", "detectable", "expected_rule", F.lit(True).alias("listed"))
    return verdicts.select("seq", "disposition", "rule_id").join(truth, "seq", "left").withColumns({"is_fault": F.coalesce("is_fault", F.lit(False)), "listed": F.coalesce("listed", F.lit(False))})


def counts(verdicts: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row of all counts that the grade is made of; designed misses stay in the denominators."""
    c = F.col
    quarantined = c("disposition") == "quarantine"
    per_class = []
    for name, rule in CLASS_RULES.items():
        mine = c("is_fault") & (c("fault_class") == name)
        key = rule.lower()
        per_class += [
            F.count_if(mine).alias(f"{key}_faults"),
            F.count_if(mine & quarantined & (c("rule_id") == rule)).alias(f"{key}_caught"),
            F.count_if(mine & ~c("detectable")).alias(f"{key}_designed_misses"),
            F.count_if(quarantined & (c("rule_id") == rule)).alias(f"{key}_quarantined"),
        ]
    return labelled(verdicts, manifest).agg(
        *per_class,
        F.count_if(~c("is_fault")).alias("controls"),
        F.count_if(~c("is_fault") & quarantined).alias("controls_quarantined"),
        F.count_if(~c("is_fault") & c("listed")).alias("boundary_controls"),
        F.count_if(~c("is_fault") & c("listed") & quarantined).alias("boundary_quarantined"),
        F.count(F.lit(1)).alias("verdicts"),
        F.count_distinct("seq").alias("distinct_seq"),
        F.count_if(~quarantined).alias("valid"),
        F.count_if(quarantined).alias("quarantined"),
    )


def grade(verdicts: DataFrame, manifest: DataFrame, n_total: int) -> dict:
    """Recall and precision of each class, false quarantine rates, completeness (loss, and duplicates as measured)."""
    n = counts(verdicts, manifest).first().asDict()
    classes = {}
    for name, rule in CLASS_RULES.items():
        k = rule.lower()
        caught, faults, found = n[f"{k}_caught"], n[f"{k}_faults"], n[f"{k}_quarantined"]
        classes[name] = {"rule": rule, "recall": proportion(caught, faults), "precision": proportion(caught, found), "designed_misses": n[f"{k}_designed_misses"]}
    return {
        "classes": classes,
        "false_quarantine": {"all_controls": proportion(n["controls_quarantined"], n["controls"]), "boundary_controls": proportion(n["boundary_quarantined"], n["boundary_controls"])},
        "completeness": {"total": n_total, "valid": n["valid"], "quarantined": n["quarantined"], "loss": n_total - n["distinct_seq"], "duplicate": n["verdicts"] - n["distinct_seq"]},
    }


def as_document(graded) -> dict:
    if isinstance(graded, Estimate):
        return graded.as_dict()
    return {k: as_document(v) for k, v in graded.items()} if isinstance(graded, dict) else graded
