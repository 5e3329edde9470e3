"""School matching. Applicants: applicant_id, gpa_text, school_bg, countries, highlights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import parse_float
from ..sources import catalogs as cat

LEVELS = ["reach", "match", "safety"]
#: How many of each level are listed, and how many of these are open.
SHORTLIST = {"reach": (3, 1), "match": (4, 2), "safety": (2, 1)}


def validate_gpa(df: DataFrame) -> DataFrame:
    """gpa, and gpa_error: required for no text, range for no number or one outside 0 to 4."""
    text, value = F.coalesce("gpa_text", F.lit("")), parse_float(F.col("gpa_text"))
    error = F.when(text == "", "required").when(value.isNull() | (value < 0) | (value > 4.0), "range")
    return df.withColumns({"gpa": value, "gpa_error": error})


def adjust_gpa(df: DataFrame) -> DataFrame:
    """adjusted_gpa: gpa plus what the background adds; an unknown background adds nothing."""
    adj = F.create_map(*[F.lit(x) for pair in cat.BACKGROUNDS for x in pair])
    return df.withColumn("adjusted_gpa", F.col("gpa") + F.coalesce(F.try_element_at(adj, F.col("school_bg")), F.lit(0.0)))


#: What is known of a school in a match, in the order of the catalog's columns.
_SCHOOL = {"pos": (0, "int"), "school_id": (1, "string"), "country": (4, "string"), "ranking": (5, "int"), "req_gpa": (6, "double")}


def matched(applicants: DataFrame) -> DataFrame:
    """Each valid applicant with `matches`: the schools within reach in catalog order, as an array of structs.

    The catalog is a constant array in the row, so matching, ranking and counting
    need no join and no shuffle; rows are multiplied at the end, if at all.
    Highlights widen reach only. No countries, or null, mean all of them; null
    highlights are none.
    """
    valid = adjust_gpa(validate_gpa(applicants).where(F.col("gpa_error").isNull()))
    lower = F.lit(-0.4) - F.least(F.coalesce(F.size("highlights"), F.lit(0)) * F.lit(0.05), F.lit(0.15))
    every = F.array(*[F.struct(*[F.lit(r[k]).cast(t).alias(c) for c, (k, t) in _SCHOOL.items()]) for r in cat.school_rows()])
    anywhere = F.coalesce(F.size("countries"), F.lit(0)) <= 0

    def judged(s: Column) -> Column:
        diff = F.col("adjusted_gpa") - s["req_gpa"]
        level = F.when(diff >= 0.2, "safety").when(diff >= -0.15, "match").when(diff >= F.col("reach_bound"), "reach")
        wanted = F.col("anywhere") | F.coalesce(F.array_contains("countries", s["country"]), F.lit(False))
        return F.struct(*[s[c].alias(c) for c in _SCHOOL], F.when(wanted, level).alias("match_level"), diff.alias("match_score"))

    rows = valid.withColumns({"reach_bound": lower, "anywhere": anywhere})
    found = F.filter(F.transform(every, judged), lambda m: m["match_level"].isNotNull())
    return rows.select(*[c for c in applicants.columns if c not in ("countries", "highlights")], found.alias("matches"))


def match_schools(applicants: DataFrame) -> DataFrame:
    """Each valid applicant with the schools within reach: level and score, at most 26 rows an applicant."""
    return matched(applicants).select("applicant_id", F.inline("matches"))


def ranked(applicants: DataFrame) -> DataFrame:
    """matched(), with an array for each level in order of rank: match by nearness, the others by required GPA downward; ties in catalog order."""

    def ordered(level: str) -> Column:
        key = (lambda m: F.abs(m["match_score"])) if level == "match" else (lambda m: -m["req_gpa"])
        mine = F.filter("matches", lambda m: m["match_level"] == level)
        return F.array_sort(F.transform(mine, lambda m: F.struct(key(m).alias("key"), m["pos"].alias("pos"), m["school_id"].alias("school_id"))))

    return matched(applicants).withColumns({level: ordered(level) for level in LEVELS})


def _numbered(ranks: Column, level: str) -> Column:
    return F.transform(ranks, lambda m, n: F.struct(m["school_id"].alias("school_id"), F.lit(level).alias("match_level"), (n + 1).alias("rn")))


def _rows(df: DataFrame, of: dict[str, Column], fields: list[str]) -> DataFrame:
    """A row for each entry of the levels' arrays, with its place among them."""
    return df.select("applicant_id", F.inline(F.concat(*[_numbered(a, level) for level, a in of.items()]))).select("applicant_id", *fields)


def school_ranks(applicants: DataFrame) -> DataFrame:
    """applicant_id, school_id, match_level and rn of every match; no shuffle."""
    return _rows(ranked(applicants), {k: F.col(k) for k in LEVELS}, ["school_id", "match_level", "rn"])


def school_shortlist(applicants: DataFrame) -> DataFrame:
    """The first of each level, the later ones locked; no shuffle."""
    out = _rows(ranked(applicants), {k: F.slice(k, 1, most) for k, (most, _) in SHORTLIST.items()}, ["school_id", "match_level", "rn"])
    opened = F.lit(0)
    for level, (_, free) in SHORTLIST.items():
        opened = F.when(F.col("match_level") == level, free).otherwise(opened)
    return out.withColumn("is_locked", F.col("rn") > opened)


def school_counts(applicants: DataFrame) -> DataFrame:
    """How many schools of each level; valid applicants without a match have zeros. No shuffle."""
    count = lambda level: F.size(F.filter("matches", lambda m: m["match_level"] == level)).cast("long")
    return matched(applicants).select("applicant_id", *[count(k).alias(k) for k in LEVELS])


def rank_matches(matches: DataFrame) -> DataFrame:
    """rn within applicant and level: match by nearness, the others by required GPA downward; ties in catalog order."""
    key = F.when(F.col("match_level") == "match", F.abs("match_score")).otherwise(-F.col("req_gpa"))
    return matches.withColumn("rn", F.row_number().over(W.partitionBy("applicant_id", "match_level").orderBy(key, "pos")))


def shortlist(ranked: DataFrame) -> DataFrame:
    """The first of each level, the later ones locked. The constant bound comes first, so that Spark limits each group before the shuffle."""
    total = F.lit(0)
    opened = F.lit(0)
    for level, (most, free) in SHORTLIST.items():
        total = F.when(F.col("match_level") == level, most).otherwise(total)
        opened = F.when(F.col("match_level") == level, free).otherwise(opened)
    out = ranked.where(F.col("rn") <= max(most for most, _ in SHORTLIST.values())).where(F.col("rn") <= total)
    return out.withColumn("is_locked", F.col("rn") > opened)


def school_demand(applicants: DataFrame) -> DataFrame:
    """Every school of the catalog with what it asks for and how many applicants reach it at each level; partial counts, 26 rows after the shuffle."""
    counts = match_schools(applicants).groupBy("school_id").agg(*[F.sum((F.col("match_level") == k).cast("long")).alias(k) for k in LEVELS])
    schools = cat.schools(applicants.sparkSession)
    return schools.join(counts, "school_id", "left").select(*schools.columns, *[F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in LEVELS])


def match_summary(applicants: DataFrame, matches: DataFrame) -> DataFrame:
    """How many schools of each level; valid applicants without a match have zeros."""
    valid = validate_gpa(applicants).where(F.col("gpa_error").isNull()).select("applicant_id")
    counts = matches.groupBy("applicant_id").agg(*[F.sum((F.col("match_level") == k).cast("long")).alias(k) for k in LEVELS])
    return valid.join(counts, "applicant_id", "left").select("applicant_id", *[F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in LEVELS])
