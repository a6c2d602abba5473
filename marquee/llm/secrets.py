"""Secret scan: patterns in every text, and who owns each candidate over the whole corpus.

Built-in functions only. A candidate that several owners or many repositories have is a
widely copied example; one of a single owner and few repositories that looks random is taken
for a live credential, and what lies between is shared by a few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import landed

#: Kinds in order: pattern, group that holds the secret, least length of that group.
#: Loops are possessive; what follows each never begins with what it has eaten.
KINDS = {
    "assign": (
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
        r"([A-Za-z0-9+/_.=-]++)",
        1,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]++", 0, 20),
    # Runs that are too short would be dropped anyway.
    "hex": (r"[0-9a-f]{24,}+", 0, 24),
}
METHOD = ("copied", "live", "shared")
ORDER = [*KINDS, *METHOD]
PIECES = "array<struct<kind:string,i:int,gap:int,size:int,secret:string>>"
SPANS = "array<struct<kind:string,start:bigint,end:bigint,n_owners:bigint,n_repositories:bigint>>"
#: A candidate of this many owners or more, or of more repositories than this whoever owns
#: them, is a copied example; one of one owner and up to so many repositories is its own.
COPIED_OWNERS, COPIED_REPOSITORIES, OWN_REPOSITORIES = 3, 10, 3
#: What looks random has so many different characters, and of its pairs of neighbouring
#: characters this percentage changes between digits, small and capital letters and others:
#: half of the pairs do in random hex, few in words with a number.
RANDOM_DISTINCT, RANDOM_CHANGES = 8, 25


def _pieces(kind: str) -> Column:
    """Matches of a kind in order: the length of the text since the match before, the
    match's own length and its secret."""
    pattern, group, _ = KINDS[kind]
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    secret = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    gaps = F.split("text", pattern, -1)
    zipped = F.arrays_zip(
        F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"), whole.alias("whole"), secret.alias("secret")
    )
    pieces = F.transform(
        zipped,
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(z["gap"]).alias("gap"),
            F.length(z["whole"]).alias("size"),
            z["secret"].alias("secret"),
        ),
    )
    return F.when(F.col("text").rlike(pattern), pieces).otherwise(F.array().cast(PIECES))


def matches(docs: DataFrame) -> DataFrame:
    """Base matches of (doc_id, text, owner, repository): doc_id, h (hash of the text),
    owner, repository, kind, start, end, secret; positions in code points, and matches
    whose secret is too short left out."""
    split = docs.select(
        "doc_id",
        F.xxhash64("text").alias("h"),
        "owner",
        "repository",
        F.inline(F.concat(*[_pieces(k) for k in KINDS])),
    ).dropDuplicates(["doc_id", "h", "owner", "repository", "kind", "i"])
    in_text = Window.partitionBy("doc_id", "h", "owner", "repository", "kind").orderBy("i")
    long_enough = F.lit(False)
    for kind, (_, _, least) in KINDS.items():
        long_enough |= (F.col("kind") == kind) & (F.length("secret") >= least)
    return (
        split.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(in_text))
        .filter(long_enough)
        .select(
            "doc_id",
            "h",
            "owner",
            "repository",
            "kind",
            (F.col("end") - F.col("size")).alias("start"),
            "end",
            "secret",
        )
    )


def looks_random() -> Column:
    """Enough different characters, and enough changes of class between neighbours."""
    different = F.size(F.array_distinct(F.split("secret", "")))
    runs = F.col("secret")
    for pattern, one in (("[0-9]+", "0"), ("[a-z]+", "a"), ("[A-Z]+", "A"), ("[^0aA]+", "-")):
        runs = F.regexp_replace(runs, pattern, one)
    changes = F.length(runs) - 1
    return (different >= RANDOM_DISTINCT) & (
        100 * changes >= RANDOM_CHANGES * (F.length("secret") - 1)
    )


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_owners, n_repositories) of every candidate, pre-aggregated in each task."""
    return (
        found.groupBy("value", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value", "owner")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))
    )


def scan(
    docs: DataFrame,
    *,
    owner: str = "source",
    repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
    own_repositories: int = OWN_REPOSITORIES,
) -> DataFrame:
    """Secrets in every row of ``docs`` (doc_id, text, owner, repository).

    Result: doc_id and spans, an array of (kind, start, end, n_owners, n_repositories) by
    start, kind and end. Kinds ``assign``, ``access`` and ``hex`` are the base matches.
    The secret inside one gets another span: ``copied`` where ``copied_owners`` different
    owners or more have it, or more than ``copied_repositories`` repositories; otherwise, if
    it looks random, ``live`` where one owner alone has it in up to ``own_repositories``
    repositories, and ``shared`` where two owners or more repositories do.

    A null text has no spans. Null owners are one owner, null repositories of an owner one
    repository. Rows alike in doc_id and text count as one document of all its owners and
    get the same spans. Other columns are left out, so their names can't clash. An empty
    table gives no rows. Secrets are compared by 64-bit hashes.
    """
    named = docs.select(
        "doc_id", "text", F.col(owner).alias("owner"), F.col(repository).alias("repository")
    )
    found = landed(
        matches(named).select(
            "*", F.xxhash64("secret").alias("value"), F.length("secret").alias("n"), looks_random().alias("random")
        ).drop("secret"),
        "secrets",
    )
    owned = found.join(ownership(found), "value")
    own = (F.col("n_owners") == 1) & (F.col("n_repositories") <= own_repositories)
    many = (F.col("n_owners") >= copied_owners) | (F.col("n_repositories") > copied_repositories)
    verdict = F.when(many, "copied").when(
        F.col("random"), F.when(own, "live").otherwise("shared")
    )
    counts = ["n_owners", "n_repositories"]
    base = owned.select("doc_id", "h", "kind", "start", "end", *counts)
    more = owned.select(
        "doc_id", "h", verdict.alias("kind"), (F.col("end") - F.col("n")).alias("start"), "end", *counts
    ).filter("kind is not null")
    order = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    # A text's own matches, met once however many owners its rows have.
    listed = (
        base.union(more)
        .groupBy("doc_id", "h")
        .agg(
            F.sort_array(
                F.collect_set(F.struct("start", order.alias("order"), "end", "kind", *counts))
            ).alias("spans")
        )
        .select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), "spans")
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("_h0"))
    joined = rows.join(
        listed, (F.col("_h0") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left"
    )
    shown = F.transform(
        "spans", lambda s: F.struct(*[s[c].alias(c) for c in ["kind", "start", "end", *counts]])
    )
    return joined.select("doc_id", F.coalesce(shown, F.array().cast(SPANS)).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of all ``spans``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
