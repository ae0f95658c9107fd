"""Audit: what a prompt asks for, and whether a record's components cover it. One pass over the records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab


def _asked(alias: str) -> str:
    """SQL test for an alias in the lower-cased prompt p: a whole word if it is short."""
    literal = "".join(f"\\{c}" if c in ".-+*?()[]" else c for c in alias)
    return f"p RLIKE r'\\b{literal}\\b'" if len(alias) <= 6 else f"contains(p, '{alias}')"


def keywords(prompt: str) -> str:
    """SQL for the keywords that a prompt mentions, in the order of the vocabulary."""
    tests = ", ".join(f"IF({' OR '.join(map(_asked, aliases))}, '{k}', NULL)" for k, aliases in vocab.KEYWORDS.items())
    return f"transform(array(lower(coalesce({prompt}, ''))), p -> array_compact(array({tests})))[0]"


def covered(keyword: str) -> str:
    """SQL test whether components cover a keyword: a word of theirs, or a role. Keywords without either always are."""
    cases = []
    for k, (words, roles) in vocab.COVERAGE.items():
        if not words and not roles:
            continue
        text = " OR ".join(f"contains(t.w, '{w}')" for w in words)
        role = " OR ".join(f"t.r = '{r}'" for r in roles)
        cases.append(f"WHEN '{k}' THEN exists(told, t -> {' OR '.join(x for x in (text, role) if x)})")
    return f"CASE {keyword} {' '.join(cases)} ELSE TRUE END"


def audit_records(records: DataFrame) -> DataFrame:
    """(project_id, variant_type, prompt_keywords, mismatches, coverage_ratio) of each record. A null prompt asks for
    nothing, and what nothing is asked of is covered whole."""
    told = "transform(coalesce(components, array()), c -> named_struct('w', lower(concat_ws(' ', coalesce(c.component_id, ''), coalesce(c.display_name, ''), coalesce(c.description, ''))), 'r', lower(coalesce(c.functional_role, ''))))"
    df = records.select(F.col("project.project_id").alias("project_id"), F.col("project.variant_type").alias("variant_type"), F.expr(keywords("project.original_prompt")).alias("prompt_keywords"), F.expr(told).alias("told"))
    df = df.withColumn("mismatches", F.expr(f"filter(prompt_keywords, k -> NOT ({covered('k')}))"))
    ratio = F.when(F.size("prompt_keywords") > 0, F.round(1.0 - F.size("mismatches") / F.size("prompt_keywords"), 3)).otherwise(1.0)
    return df.withColumn("coverage_ratio", ratio).drop("told")


def audit_summary(audited: DataFrame) -> DataFrame:
    """(variant_type, records, with_keywords, with_mismatches, mismatches) by type, and for ALL."""
    some = lambda c: F.count(F.when(F.size(c) > 0, 1))
    kind = F.coalesce("variant_type", F.lit("unknown"))
    out = audited.select(kind.alias("variant_type"), "prompt_keywords", "mismatches").rollup("variant_type")
    out = out.agg(F.count(F.lit(1)).alias("records"), some("prompt_keywords").alias("with_keywords"), some("mismatches").alias("with_mismatches"), F.coalesce(F.sum(F.size("mismatches")), F.lit(0)).alias("mismatches"))
    return out.withColumn("variant_type", F.coalesce("variant_type", F.lit("ALL")))


def missed_keywords(audited: DataFrame) -> DataFrame:
    """(keyword, n): how often each asked keyword is not covered."""
    return audited.select(F.explode("mismatches").alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))
