"""Header mapping: free-form file headers to canonical column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.profiles import ChainProfile, strict_rules

# Characters removed from headers on matching and on export.
BOM = "\ufeff"
EXPORT_DROPPED = "[]()\"'"


def clean_header(header: str) -> str:
    """The form a header is matched in."""
    return header.lower().strip().replace(BOM, "").replace('"', "")


def export_header(header: str) -> str:
    """The form a header is exported in."""
    return header.strip().translate(str.maketrans("", "", EXPORT_DROPPED))


def free_name(name: str, used: set[str]) -> str:
    """``name``, or ``name_1``, ``name_2`` ... if taken; ``used`` holds lower-case names."""
    candidate, n = name, 0
    while candidate.lower() in used:
        n += 1
        candidate = f"{name}_{n}"
    return candidate


def dedupe_names(names: list[str]) -> list[str]:
    """Number repeated names; Spark tells names apart by more than case only."""
    used: set[str] = set()
    result = []
    for name in names:
        unique = free_name(name, used)
        used.add(unique.lower())
        result.append(unique)
    return result


def canonical_names(headers: list[str], profile: ChainProfile, rules: str = "compat") -> list[str]:
    """Canonical names in header order; the first matching rule of the profile wins.

    Headers no rule matches keep their name and reserve it. ``rules='strict'`` tests product
    codes before product names, so that a product code header is not taken for a name.
    """
    active = strict_rules(profile.rules) if rules == "strict" else profile.rules
    cleaned = [clean_header(h) for h in headers]
    used = {c for c in cleaned if not any(r.matches(c, set()) for r in active)}
    names = []
    for header, clean in zip(headers, cleaned):
        target = next((r.target for r in active if r.matches(clean, used)), None)
        if target is not None:
            target = free_name(target, used)
            used.add(target.lower())
        names.append(header if target is None else target)
    return dedupe_names(names)


def standardize_columns(df: DataFrame, profile: ChainProfile, rules: str = "compat") -> DataFrame:
    """Rename all columns in one projection."""
    return df.toDF(*canonical_names(df.columns, profile, rules))
