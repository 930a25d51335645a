"""Comparison of translation databases as one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import comparing
from ..sinks.files import document
from .state import now

EXAMPLES, MATCHES = 50, 20


def _statistics(t: DataFrame) -> dict:
    found = comparing.statistics(t).first()
    by_language = t.groupBy("language").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "language")
    return {"species_count": found["species"], "translation_count": found["translations"], "language_count": found["languages"], "languages": {r["language"]: r["n"] for r in by_language.collect()}}


def analysis(databases: dict[str, DataFrame]) -> dict:
    """What databases of (species, language, name) have, pair by pair and all of them together.

    With three the last one is what the first two are held against. What is collected has a row for each language."""
    names = list(databases)
    out: dict = {"generated_at": now(), "databases": {n: _statistics(t) for n, t in databases.items()}, "pairs": {}}
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            met = comparing.overlap(databases[a], databases[b])
            sets = comparing.language_sets(databases[a], databases[b])
            out["pairs"][f"{a}-{b}"] = {
                "overlap": [r.asDict() for r in met.orderBy("language").collect()],
                "recommendation": [r.asDict() for r in comparing.recommendation(met).orderBy("language").collect()],
                "savings": comparing.savings(met).first().asDict(),
                "languages": {side: sorted(r["language"] for r in sets.where(F.col("side") == side).collect()) for side in ("shared", "first_only", "second_only")},
                "verdict": comparing.verdict(sets, comparing.coverage(databases[a], databases[b])).first().asDict(),
            }
    if len(names) == 3:
        a, b, c = databases.values()
        matched = comparing.three_way(a, b, c)
        counts = {r["agreement"]: r["count"] for r in matched.groupBy("agreement").count().collect()}
        order = ["language", "species"]
        named = matched.join(a.select("species", "language", F.col("name").alias(names[0])), order).join(b.select("species", "language", F.col("name").alias(names[1])), order).join(c.select("species", "language", F.col("name").alias(names[2])), order)
        first = lambda rows, n: [r.asDict() for r in rows.orderBy(*order).limit(n).collect()]
        out["three_way"] = {
            "total_matches": counts.get("all", 0),
            "total_differences": sum(n for k, n in counts.items() if k != "all"),
            "match_examples": first(named.where("agreement = 'all'"), MATCHES),
            "difference_examples": first(named.where("agreement <> 'all'"), EXAMPLES),
            "combined": comparing.combined_against(a, b, c).first().asDict(),
        }
    return out


def export(databases: dict[str, DataFrame], path: str) -> dict:
    """The analysis, written as a JSON document."""
    made = analysis(databases)
    document(made, path)
    return made
