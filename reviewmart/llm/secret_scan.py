"""Secret scan with corpus-wide ownership.

Patterns propose candidates. Each candidate's value is hashed, and the hashes are counted over the
corpus by distinct owners and repositories. A value that ``example_owners`` carry is an example
copied around, and so is one that two owners carry into ``example_repositories`` at least. What one
owner has, in however many repositories, is that owner's: if it looks random it is taken for a live
credential. Random tokens that no pattern names are candidates too, reported only if one owner has them.

Null and empty texts have no candidates, and texts of any length are scanned whole; a null owner or
repository counts as one owner or repository of its own. Repeated rows add nothing to either count
and are each scanned, with the same verdict. An empty table has no rows. Spans count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm import spans as S
from reviewmart.llm.common import as_doc, let, text_of
from reviewmart.workspace import cut

KINDS = ("assign", "access", "hex", "random")
# The candidates' form and least lengths.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RANDOM = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 8
# A value of this many owners at least is an example, or of two in so many repositories; more
# distinct characters look random.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 4
RANDOM_CHARACTERS = 8


def candidates(text: Column) -> Column:
    """Spans of all candidates, the random tokens only where no other candidate touches them."""
    assigned = F.filter(
        S.found(text, "assign", ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE
    )
    known = F.concat(assigned, S.found(text, "access", ACCESS), S.found(text, "hex", HEX))
    loose = F.filter(
        S.found(text, "random", RANDOM),
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]") & _looks_random(s["value"]),
    )

    def joined(both: Column) -> Column:
        apart = F.filter(
            both["loose"],
            lambda s: ~F.exists(
                both["known"], lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])
            ),
        )
        return F.concat(both["known"], apart)

    return let(F.struct(known.alias("known"), loose.alias("loose")), joined)


def _looks_random(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, ""))) >= RANDOM_CHARACTERS


def scan(
    docs: DataFrame,
    text_col: str = "text",
    owner_col: str = "source",
    repository_cols: tuple[str, ...] = ("source", "lang"),
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """``doc`` and ``secrets``: spans with ``live``, ``owners`` and ``repositories``.

    Only documents with candidates are written and joined; the others pass by. The join is on a
    value's hash, one row each on the counted side, so that hot values can be split.
    """
    scanned = docs.select(as_doc(docs), candidates(text_of(docs, text_col)).alias("spans"))
    found = cut(
        scanned.where(F.size("spans") > 0).withColumn("row", F.monotonically_increasing_id()),
        "secret-candidates",
    )
    owner = F.col(f"doc.`{owner_col}`")
    repository = F.xxhash64(*(F.col(f"doc.`{name}`").isNull() for name in repository_cols), *(f"doc.`{name}`" for name in repository_cols))
    each = found.select(
        "row",
        F.xxhash64(owner.isNull(), owner).alias("owner"),
        repository.alias("repository"),
        F.explode("spans").alias("span"),
    ).withColumn("value", F.sha2(F.col("span.value"), 256))
    carried = each.groupBy("value").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")
    )
    copied = (F.col("owners") >= example_owners) | (
        (F.col("owners") >= 2) & (F.col("repositories") >= example_repositories)
    )
    judged = (
        each.select("row", "span", "value")
        .join(carried, "value")
        .withColumn(
            "live",
            ~copied
            & (_looks_random(F.col("span.value")) | (F.col("span.kind") != "assign")),
        )
        .where((F.col("span.kind") != "random") | ((F.col("owners") == 1) & F.col("live")))
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct("span.kind", "span.start", "span.end", "live", "owners", "repositories")
            ).alias("secrets")
        )
    )
    with_verdict = found.join(judged, "row", "left").select("doc", "secrets")
    kind = with_verdict.schema["secrets"].dataType
    without = scanned.where(F.size("spans") == 0).select("doc", F.lit(None).cast(kind).alias("secrets"))
    both = with_verdict.unionByName(without)
    return both.withColumn("secrets", F.coalesce("secrets", F.array().cast(kind)))


def redact(text: Column, secrets: Column) -> Column:
    """``text`` with live secrets put out of sight, overlapping ones as one; examples stay."""
    live = F.transform(
        F.filter(secrets, lambda s: s["live"]),
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.concat(F.lit("[secret:"), s["kind"], F.lit("]")).alias("value"),
        ),
    )
    return F.when(F.exists(secrets, lambda s: s["live"]), S.replaced(text, live, united=True)).otherwise(text)
