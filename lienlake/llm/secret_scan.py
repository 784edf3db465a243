"""Secrets and how widely the corpus shares them (operator 3).

Candidates are found in each text with their places: keyword assignments,
access keys and long hexadecimal runs (the base), and, as the method's own
kinds, keys with a vendor's prefix and long random-looking tokens.  Places come
from cutting the text at the matches: the pieces between them are as long as
they are, so running sums of lengths give every start and end in code points.

Each candidate's value is hashed and the corpus is aggregated by hash: how many
repositories and how many owners have it.  A value that ``widely`` or more
owners or ``copied`` or more repositories have is an example that was copied
around; one that a single owner has in fewer repositories, looks random and is
not a placeholder is a live-looking credential; what several owners share is
neither.  Spans of the method's own kinds are kept only if they are live-looking;
base spans always stay.

Aggregation is over (hash, owner, repository) first, so a value that a third of
the corpus has is reduced where it is found.

Cases: a null text is empty; the null owner is an owner of its own, and so is the
null repository a repository; rows with the same id and text have the same spans; an empty table gives an empty
result; an empty text has no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, row_key, text_or_empty

# The base patterns, in the order of their kinds.  A match shorter than the least length is dropped.
_KEY = "(?:[Pp][Aa][Ss][Ss][Ww](?:[Oo][Rr])?[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_LEAD = _KEY + r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = _LEAD + r"[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
# The method's kinds.
VENDOR = (r"(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
          r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})")
RANDOM = "[A-Za-z0-9+/_-]{24,}"

KINDS = ("assign", "access", "hex", "vendor", "random")
BASE = 3


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, match) of the pattern's matches."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>").alias("of"))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.when(x["match"].isNull(), acc["of"]).otherwise(F.concat(acc["of"], F.array(one))).alias("of"))
    return F.aggregate(pieces, empty, add)["of"]


def _scan(text: Column) -> list[Column]:
    """The candidates of each kind; patterns run only over texts that a cheaper test lets through."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    assign = F.when(text.rlike(ASSIGN), _found(text, ASSIGN, 0)).otherwise(none)
    access = F.when(text.contains("AKIA"), _found(text, ACCESS, 1)).otherwise(none)
    hexes = F.when(text.rlike(HEX), _found(text, HEX, 2)).otherwise(none)
    vendor = F.when(text.rlike("gh[pousr]_|sk_live_|xox[abprs]-|AIza|eyJ"), _found(text, VENDOR, 3)).otherwise(none)
    random = F.when(text.rlike(RANDOM), _found(text, RANDOM, 4)).otherwise(none)
    value = lambda x: F.regexp_replace(x["match"], "^" + _LEAD, "")
    # a random token has letters and digits, and is not what the other kinds find
    token = lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]") & ~x["match"].rlike("^[0-9a-f]+$")
    return [F.filter(assign, lambda x: F.length(value(x)) >= 8), F.filter(access, lambda x: F.length(x["match"]) >= 16), hexes,
            vendor, F.filter(random, token)]


def _looks_random(value: Column) -> Column:
    """Many different characters for its length, and no placeholder."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (different >= F.least(F.lit(10), F.length(value) / 2)) & ~F.lower(value).rlike("example|sample|placeholder|changeme|your|dummy|x{4}|0{8}|1234567")


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, rk (row key) and found, the candidates' array, for every row."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), text_or_empty(text_col).alias("text"),
                       *[F.col(c) for c in docs.columns if c in ("owner", "repository")])
    *others, random = _scan(text)
    rows = rows.withColumn("others", F.concat(*others)).withColumn("random", random)
    inside = lambda x, y: (y["start"] < x["end"]) & (x["start"] < y["end"])
    alone = F.filter("random", lambda x: ~F.exists("others", lambda y: inside(x, y)))
    return rows.withColumn("found", F.concat("others", alone)).drop("text", "others", "random")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repository_col: str = "doc_id", widely: int = 3, copied: int = 10) -> DataFrame:
    """One row per row: doc_id, rk, spans - array of (start, kind, end, value hash, owners, repositories, live), by
    start, then kind; kind counts in KINDS."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(owner_col).alias("owner"),
                       F.col(repository_col).alias("repository"))
    rows = cut(candidates(rows, "doc_id", "text"))
    value = F.when(F.col("x.kind") == 0, F.regexp_replace("x.match", "^" + _LEAD, "")).otherwise(F.col("x.match"))
    each = rows.filter(F.size("found") > 0).select("rk", "owner", "repository", F.explode("found").alias("x"))
    each = each.select("rk", "owner", "repository", "x.start", "x.kind", "x.end", value.alias("value"))
    each = each.withColumn("hash", F.sha2("value", 256))
    # a null is a value of its own
    number = lambda c: F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))
    shared = (each.select("hash", "owner", "repository").distinct().groupBy("hash")
              .agg(number("owner").alias("owners"), number("repository").alias("repositories")))
    example = (F.col("owners") >= widely) | (F.col("repositories") >= copied)
    live = ~example & (F.col("owners") == 1) & _looks_random(F.col("value"))
    judged = each.join(cut(shared), "hash").withColumn("live", live)
    # a span of the method's own must be live-looking
    kept = judged.filter((F.col("kind") < BASE) | F.col("live"))
    one = F.struct("start", "kind", "end", "hash", "owners", "repositories", "live")
    spans = kept.groupBy("rk").agg(F.sort_array(F.collect_set(one)).alias("spans"))
    nothing = F.array().cast(spans.schema["spans"].dataType)
    return (rows.select("doc_id", "rk").join(spans, "rk", "left")
            .select("doc_id", "rk", F.coalesce("spans", nothing).alias("spans")))


def digest(spans: Column, upto: int = len(KINDS)) -> Column:
    """The spans of the first ``upto`` kinds as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"] < upto),
                                    lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
