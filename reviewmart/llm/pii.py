"""Personal data, and the words that give it away.

Patterns find the protected entities. For each word of a document with an entity, wherever it
stands, document counts over the whole corpus tell how much of the entity the word discloses: their
pointwise mutual information over the entity's own information, 1 if the word never occurs without
it. In the documents that hold the entity, all occurrences of words above the upper threshold are
removed, and of those between the two replaced by their kind.

Most personal data are rare, so an entity in fewer documents than the support stands for its class:
the first of the levels below that enough documents have. A word is then judged by how much it tells
of the class.

========  ==============  ====================  ===================  ==============
level     email           ip                    card                 phone
========  ==============  ====================  ===================  ==============
0         the address     the address           the number           the number
1         its domain      its first two parts   its first 6 digits   first 4 digits
2         top domain      its first part        its first digit      first 2 digits
3         any email       any ip                any card             any phone
========  ==============  ====================  ===================  ==============

Where even the kind is rarer than the support, or in every document, the entity is replaced, and no
word beside it is. Null and empty texts have no entities; texts of any length are taken whole.
Repeated rows are documents of their own in every count, so a corpus should be deduplicated before;
rows alike are judged alike. An empty table has no rows. Spans count code points; a word inside an
entity is no term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm import spans as S
from reviewmart.llm.common import as_doc, text_of
from reviewmart.workspace import cut

KINDS = ("email", "ip", "card", "phone", "term")
# The entities' forms. Possessive loops find the same matches without backtracking;
# a look behind keeps a long run from being tried from each of its characters.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
_CARD_LENGTH = r"[0-9](?:[\x20-]?[0-9]){12}"
TERM = r"\p{L}[\p{L}\p{N}]{2,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(digit: Column, at: Column) -> Column:
        d = digit.cast("int") * F.when(at % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def entities(text: Column) -> Column:
    """Spans of all protected entities; overlapping ones of different kinds all stay."""
    email = F.when(text.contains("@"), S.found(text, "email", EMAIL)).otherwise(S.none())
    ip = F.filter(
        S.found(text, "ip", IP),
        lambda s: F.forall(F.split(s["value"], r"\."), lambda part: part.rlike(_BYTE)),
    )
    card = F.when(
        text.rlike(_CARD_LENGTH),
        F.filter(
            S.found(text, "card", CARD),
            lambda s: F.length(_digits(s["value"])).between(13, 19) & _luhn(_digits(s["value"])),
        ),
    ).otherwise(S.none())
    phone = F.when(
        text.contains("+"),
        F.filter(
            S.found(text, "phone", PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15)
        ),
    ).otherwise(S.none())
    return F.concat(email, ip, card, phone)


def _levels(span: Column) -> Column:
    """The entity's own key and those of its classes, from the narrowest to the widest."""
    kind, value = span["kind"], F.lower(span["value"])
    digits = _digits(value)

    def classes(email: str, ip: str, card: int, phone: int) -> Column:
        return (
            F.when(kind == "email", F.regexp_extract(value, email, 0))
            .when(kind == "ip", F.regexp_extract(value, ip, 0))
            .when(kind == "card", F.left(digits, F.lit(card)))
            .otherwise(F.left(digits, F.lit(phone)))
        )

    names = [
        value,
        classes("[^@]+$", r"^[0-9]+\.[0-9]+", 6, 4),
        classes(r"[^.]+$", "^[0-9]+", 1, 2),
        F.lit(""),
    ]
    return F.array(*(F.xxhash64(kind, F.lit(level), name) for level, name in enumerate(names)))


def sanitise(
    docs: DataFrame,
    text_col: str = "text",
    remove_at: float = 0.9,
    generalise_at: float = 0.75,
    support: int = 3,
) -> DataFrame:
    """``doc`` and ``spans``: entities and disclosing terms, each with its ``replacement``.

    A term is judged by an entity, or its class, if they share ``support`` documents at least. Work
    and shuffles follow the documents with entities; of others only each word's document count
    is needed, summed in each task first. A word in so many documents that no entity could be
    disclosed by it is left out before words and entities meet.
    """
    text = text_of(docs, text_col)
    scanned = docs.select(as_doc(docs), text.alias("text"), entities(text).alias("spans"))
    found = cut(
        scanned.where(F.size("spans") > 0).withColumn("row", F.monotonically_increasing_id()),
        "entities",
    )
    n = docs.count()
    keys = F.transform("spans", _levels)
    key_docs = (
        found.select(F.explode(F.array_distinct(F.flatten(keys))).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("entity_docs"))
        .where((F.col("entity_docs") >= support) & (F.col("entity_docs") < n))
    )
    each = found.select("row", F.explode(F.array_distinct(keys)).alias("keys")).select(
        "row", F.col("keys")[0].alias("own"), F.posexplode("keys").alias("level", "key")
    )
    held = cut(
        each.join(key_docs, "key")
        .groupBy("row", "own")
        .agg(F.min(F.struct("level", "key", "entity_docs")).alias("first"))
        .select("row", F.col("first.key").alias("entity"), "first.entity_docs")
        .distinct(),
        "entities-held",
    )

    def most(entity_docs: Column) -> Column:
        """Documents a word may be in to disclose an entity, even one it always comes with."""
        return F.lit(n * (1 + 1e-9)) * F.pow(entity_docs / F.lit(float(max(n, 1))), F.lit(generalise_at))

    word_docs = (
        docs.select(
            F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))).alias("w")
        )
        .groupBy(F.xxhash64("w").alias("word"))
        .agg(F.count("*").alias("word_docs"))
    )
    hottest = held.agg(F.max("entity_docs")).first()[0]
    telling = word_docs.where(F.col("word_docs").between(F.lit(support), most(F.lit(hottest or 0))))
    holding = found.select("row", "text", "spans").join(held.select("row"), "row", "left_semi")
    words = F.regexp_extract_all(S.blanked(F.col("text"), F.col("spans")), F.lit(TERM), F.lit(0))
    lowered = F.array_distinct(F.transform(words, F.lower))
    row_words = cut(
        holding.select("row", F.explode(lowered).alias("w"))
        .select("row", F.xxhash64("w").alias("word"))
        .join(telling, "word"),
        "entity-words",
    )
    met = row_words.join(held, "row").where(F.col("word_docs") <= most(F.col("entity_docs")))
    own = F.log2(F.lit(float(n)) / F.col("entity_docs"))
    mutual = F.log2(
        F.col("together") * F.lit(float(n)) / (F.col("word_docs") * F.col("entity_docs"))
    )
    disclosing = cut(
        met.groupBy("entity", "word", "entity_docs", "word_docs")
        .agg(F.count("*").alias("together"))
        .where(F.col("together") >= support)
        .select("entity", "word", (mutual / own).alias("disclosed"))
        .where(F.col("disclosed") >= generalise_at),
        "entity-terms",
    )
    judged = cut(
        met.select("row", "entity", "word")
        .join(disclosing, ["entity", "word"])
        .groupBy("row", "word")
        .agg(F.max("disclosed").alias("disclosed")),
        "judged-words",
    )
    placed = (
        found.select("row", "text", "spans")
        .join(judged.select("row"), "row", "left_semi")
        .select("row", F.explode(S.found(S.blanked(F.col("text"), F.col("spans")), "term", TERM)).alias("term"))
        .withColumn("word", F.xxhash64(F.lower("term.value")))
    )
    value = F.col("term.value")
    kind_of = F.when(value.rlike(r"\p{N}"), "[code]").when(value.rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")
    terms = (
        placed.join(judged, ["row", "word"])
        .select(
            "row",
            F.struct(
                F.lit("term").alias("kind"),
                F.col("term.start").alias("start"),
                F.col("term.end").alias("end"),
                F.when(F.col("disclosed") >= remove_at, F.lit(""))
                .otherwise(kind_of)
                .alias("replacement"),
            ).alias("span"),
        )
        .groupBy("row")
        .agg(F.collect_list("span").alias("terms"))
    )

    def ready(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.concat(F.lit("["), s["kind"], F.lit("]")).alias("replacement"),
            ),
        )

    base = ready(F.col("spans"))
    with_terms = found.join(terms, "row", "left").select(
        "doc",
        F.when(F.col("terms").isNull(), base).otherwise(F.concat(base, F.col("terms"))).alias("spans"),
    )
    without = scanned.where(F.size("spans") == 0).select("doc", base.alias("spans"))
    return with_terms.unionByName(without)


def sanitised_text(text: Column, spans: Column) -> Column:
    """The text with every span replaced; what overlapping ones cover, by the first and widest."""
    return F.when(F.size(spans) == 0, text).otherwise(
        S.replaced(
            text,
            F.transform(
                spans,
                lambda s: F.struct(
                    s["kind"].alias("kind"),
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    s["replacement"].alias("value"),
                ),
            ),
            united=True,
        )
    )
