"""Information-theoretic sanitisation of personal data (operator 1).

Two layers of spans. The base layer finds e-mail addresses, IP addresses, card and phone numbers by
pattern. The second layer treats these as protected entities and asks the corpus what else gives them
away: for a term that shares several texts with an entity, pointwise mutual information

    PMI(term, entity) = log2( p(term, entity) / (p(term) p(entity)) )

is compared with the information of the entity itself, IC(entity) = -log2 p(entity). The share
PMI / IC is 1 for a term that never occurs without the entity. Terms beyond the upper threshold are
removed, those beyond the lower one generalised to their class; both become spans.

Everything is a DataFrame expression. Patterns are split into matches and the gaps between them,
positions are running sums of their lengths. Co-occurrence is counted by whole texts: the entities of a
text meet its terms outside e-mail addresses (the only spans with letters), as far as the counts of both
allow a share beyond the threshold. A revealing term is marked wherever it stands in a text that holds its
entity, but for a word that opens the text.

Defined results: null text counts as empty, a text without findings has the digest of the empty string,
texts of any length are searched whole, repeated rows each give a row (and count as one text for the
statistics), null ids pass through, an empty table gives no rows. Only the columns named as parameters
are read; `sanitised` returns all columns with the text replaced, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import hint_if_small, keep, let, text_key

# The four patterns, written so that a match can't start inside a run it would have
# started earlier in (or right after the match before), and no repetition is tried twice.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A literal every match contains, so that texts without it are not searched.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
#: Thirteen digits with at most one separator between two of them.
LONG_NUMBER = r"[0-9](?:[\x20-]?[0-9]){12}"
TERM = r"\p{L}{3,}"
FEW_ROWS = 2_000_000


@dataclass(frozen=True)
class Disclosure:
    """Parameters of the second layer."""

    support: int = 3  # distinct texts that hold the entity, and the pair
    generalise: float = 0.75  # share of the entity's information a term may reveal
    remove: float = 0.9


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def _running(lengths: Column, fold=None, join=lambda a, b: a + b) -> Column:
    """Sum of all elements before each one, in blocks of the root of the array's size. With another `fold`
    of an array (0 for an empty one) and `join` of two results, that instead of the sum."""
    fold = fold or _sum

    def with_block(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(s.n) - 1) / s.b).cast("int"))
        sums = F.transform(blocks, lambda k: fold(F.slice(s.n, k * s.b + 1, s.b)))
        return let(F.struct(s.n.alias("n"), s.b.alias("b"), sums.alias("sums")), with_sums)

    def with_sums(s: Column) -> Column:
        ahead = F.transform(F.sequence(F.lit(0), F.size(s.sums) - 1), lambda k: fold(F.slice(s.sums, 1, k)))
        return let(F.struct(s.n.alias("n"), s.b.alias("b"), ahead.alias("ahead")), with_ahead)

    def with_ahead(s: Column) -> Column:
        def before(_, i):
            block = F.floor(i / s.b).cast("int")
            return join(F.get(s.ahead, block), fold(F.slice(s.n, block * s.b + 1, i - block * s.b)))

        return F.transform(s.n, before)

    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths)))).cast("int")
    sums = let(F.struct(lengths.alias("n"), size.alias("b")), with_block)
    return F.when(F.size(lengths) > 0, sums).otherwise(F.array().cast("array<bigint>"))


def _found(text: Column, pattern: str) -> Column:
    """Array of (match, start, end) of all matches."""

    def placed(s: Column) -> Column:
        lengths = F.transform(
            s.gaps, lambda g, i: (F.length(g) + F.coalesce(F.length(F.get(s.found, i)), F.lit(0))).cast("long")
        )
        return let(F.struct(s.found.alias("found"), s.gaps.alias("gaps"), _running(lengths).alias("at")), spans)

    def spans(s: Column) -> Column:
        def one(match, i):
            start = F.get(s.at, i) + F.length(F.get(s.gaps, i))
            return F.struct(match.alias("match"), start.alias("start"), (start + F.length(match)).alias("end"))

        return F.transform(s.found, one)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps")), placed)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(d, i):
        value = d.cast("int")
        doubled = value * 2 - F.when(value > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, doubled).otherwise(value)

    figures = F.split(F.reverse(digits), "")
    figures = F.filter(figures, lambda d: d != "")
    return F.aggregate(F.transform(figures, weighed), F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """What a match must satisfy beyond its pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    count = F.length(_digits(match))
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(_digits(match))).otherwise(False)
    return count.between(9, 15)


def _name(kind: str, match: Column) -> Column:
    """The entity behind a match, however it is written."""
    return F.concat(F.lit(kind + ":"), F.lower(match) if kind == "email" else
                    match if kind == "ip" else _digits(match))


def findings(text: Column) -> Column:
    """Array of (kind, start, end, entity) of the base layer, in the order of the kinds."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,entity:string>>")

    def of(kind: str, pattern: str) -> Column:
        found = F.filter(_found(value, pattern), lambda m: _holds(kind, m.match))
        found = F.transform(found, lambda m: F.struct(
            F.lit(kind).alias("kind"), m.start.alias("start"), m.end.alias("end"),
            _name(kind, m.match).alias("entity"),
        ))
        likely = F.contains(value, F.lit(HINTS[kind])) if kind in HINTS else value.rlike(LONG_NUMBER)
        return F.when(likely, found).otherwise(none)

    return F.concat(*(of(kind, pattern) for kind, pattern in KINDS.items()))


def _written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def searched(docs: DataFrame, text_col: str, carried: list[str]) -> DataFrame:
    """The base layer of each row, kept, with its text and a key for the row; `carried` columns ride along as a
    struct."""
    key = F.struct(*[F.col(f"`{c}`") for c in carried] or [F.lit(True).alias("none")])
    base = docs.select(
        key.alias("carried"), text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"),
        findings(F.col(text_col)).alias("found"),
    )
    return keep(base.withColumn("row", F.monotonically_increasing_id()), "found")


def distinct_texts(base: DataFrame) -> tuple[DataFrame, int]:
    """The first row of each distinct text, and how many there are. Only row numbers are shuffled while the
    rows left out are few."""
    firsts = keep(base.groupBy("text_key").agg(F.min("row").alias("row")).select("row"), "firsts")
    repeats = keep(base.select("row").join(firsts, "row", "left_anti"), "repeats")
    return base.join(hint_if_small(repeats), "row", "left_anti"), firsts.count()


def _has_email() -> Column:
    return F.contains("text", F.lit(HINTS["email"]))


def terms() -> Column:
    """The distinct terms of a row's text outside its e-mail addresses."""
    outside = F.when(_has_email(), F.regexp_replace("text", KINDS["email"], " ")).otherwise(F.col("text"))
    words = F.regexp_extract_all(F.coalesce(outside, F.lit("")), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(words, F.lower))


def placed_terms() -> Column:
    """Array of (term, start, end) of all terms of a row's text outside its e-mail addresses."""
    emails = F.filter("found", lambda f: f.kind == "email")
    gaps = F.when(_has_email(), F.split("text", KINDS["email"], -1)).otherwise(F.array("text"))

    def of_gap(gap: Column, start: Column) -> Column:
        return F.transform(_found(gap, TERM), lambda w: F.struct(
            F.lower(w.match).alias("term"), (start + w.start).alias("start"), (start + w.end).alias("end")
        ))

    def of_gaps(s: Column) -> Column:
        start = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(s.emails, i - 1).end)
        return F.flatten(F.transform(s.gaps, lambda gap, i: of_gap(gap, start(i))))

    return let(F.struct(emails.alias("emails"), gaps.alias("gaps")), of_gaps)


def _holding(rows: DataFrame) -> DataFrame:
    """(row, entity) of the base layer."""
    return rows.select("row", F.explode(F.array_distinct(F.transform("found", lambda f: f.entity))).alias("entity"))


def disclosures(base: DataFrame, rule: Disclosure) -> DataFrame:
    """(entity, term, action) of every term that reveals an entity beyond a threshold.

    Entities, terms and pairs are all counted by distinct texts, so copies of a text change nothing. Each
    count is summed on the map side first. An entity that all texts hold has no information.
    """
    single, total = distinct_texts(base)
    held = keep(_holding(single), "held")
    holders = held.groupBy("entity").agg(F.count("*").alias("with_entity"))
    held = keep(held.join(holders.where(F.col("with_entity").between(rule.support, total - 1)), "entity"), "held")
    # From share >= threshold and pairs <= with_entity: no term in more texts than this can reveal the entity.
    least = min(rule.generalise, rule.remove)
    bound = F.pow(F.col("with_entity").cast("double"), F.lit(least)) * float(max(total, 1)) ** (1 - least) * 1.000001
    most = held.agg(F.max(bound).alias("most")).first().most
    if most is None:  # nothing to look up in the corpus
        return held.select("entity", F.lit("").alias("term"), F.lit("").alias("action")).limit(0)
    spread = single.select(F.explode(terms()).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))
    spread = spread.where((F.col("with_term") >= rule.support) & (F.col("with_term") <= most))
    here = single.join(held.select("row").distinct(), "row", "left_semi").select("row", F.explode(terms()).alias("term"))
    pairs = held.join(here.join(spread, "term"), "row").where(F.col("with_term") <= bound)
    judged = pairs.groupBy("entity", "term", "with_entity", "with_term").agg(F.count("*").alias("both"))
    judged = judged.where(F.col("both") >= rule.support)
    together = F.log2(F.col("both") * total / (F.col("with_entity") * F.col("with_term")))
    share = together / F.log2(F.lit(float(total)) / F.col("with_entity"))
    action = F.when(F.col("share") >= rule.remove, "remove").when(F.col("share") >= rule.generalise, "generalise")
    judged = judged.withColumn("share", share).withColumn("action", action)
    return judged.where("action is not null").select("entity", "term", "action")


def second_layer(base: DataFrame, rule: Disclosure) -> DataFrame:
    """(row, spans): the words of each row that reveal an entity it holds."""
    each = keep(disclosures(base, rule), "revealing").groupBy("entity").agg(
        F.collect_list(F.when(F.col("action") == "remove", F.col("term"))).alias("removed"),
        F.collect_list(F.col("term")).alias("revealing"),
    )
    rows = base.where(F.size("found") > 0).select("row", "text", "found")
    marked = _holding(rows).join(each, "entity").groupBy("row").agg(
        *(F.flatten(F.collect_list(k)).alias(k) for k in ("removed", "revealing"))
    )

    def spans(s: Column) -> Column:
        hits = F.filter(s.words, lambda w: F.array_contains(s.revealing, w.term))
        # A word that reveals two entities takes the stronger treatment.
        return F.transform(hits, lambda w: F.struct(
            F.when(F.array_contains(s.removed, w.term), "term").otherwise("class").alias("kind"), w.start, w.end
        ))

    mine = [F.array_intersect(k, terms()).alias(k) for k in ("removed", "revealing")]
    more = let(F.struct(placed_terms().alias("words"), *mine), spans)
    more = more.cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.join(marked, "row").select("row", more.alias("more")).where(F.size("more") > 0)


def found_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Disclosure = Disclosure()
) -> DataFrame:
    """Per row: id, counts by kind, digest of the base spans, all spans as text."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = searched(source, "text", ["id"])
    both = base.join(second_layer(base, rule), "row", "left")
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")

    plain = F.transform("found", lambda f: F.struct(f.kind.alias("kind"), f.start.alias("start"), f.end.alias("end")))
    more = F.coalesce("more", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    return both.select(
        F.col("carried.id").alias(id_col), *map(count, KINDS), F.sha2(_written(plain), 256).alias("base_sha256"),
        _written(F.concat(plain, more)).alias("spans"), F.size(more).cast("long").alias("n_terms"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their labels; overlapping spans become one."""

    def piece(s: Column, start: Column, end: Column) -> Column:
        """Code points start to end, from blocks, so that a long text isn't walked for each piece."""
        first, last = F.floor(start / 4096), F.floor((end - 1) / 4096)
        taken = F.transform(F.sequence(first, last), lambda k: F.substring(
            F.get(s.blocks, k.cast("int")), (F.greatest(start - k * 4096, F.lit(0)) + 1).cast("int"),
            (F.least(end - k * 4096, F.lit(4096)) - F.greatest(start - k * 4096, F.lit(0))).cast("int"),
        ))
        return F.when(end > start, F.array_join(taken, "")).otherwise("")

    def merged(sorted_spans: Column) -> Column:
        """Each span that begins behind all ends before it, up to the last end before the next such span."""

        def chosen(s: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(s.spans) - 1)
            begins = F.filter(places, lambda i: F.get(s.spans, i).start >= F.get(s.prior, i))
            return let(F.struct(s.spans.alias("spans"), s.prior.alias("prior"), begins.alias("begins")), built)

        def built(s: Column) -> Column:
            ends = F.array_max(F.transform(s.spans, lambda x: x.end))
            return F.transform(s.begins, lambda b, j: F.struct(
                F.get(s.spans, b).start.alias("start"),
                F.coalesce(F.get(s.prior, F.get(s.begins, j + 1)), ends).alias("end"), F.get(s.spans, b).label.alias("label"),
            ))

        prior = _running(F.transform(sorted_spans, lambda x: x.end), lambda xs: F.coalesce(F.array_max(xs), F.lit(0)), F.greatest)
        return let(F.struct(sorted_spans.alias("spans"), prior.alias("prior")), chosen)

    def masked(s: Column) -> Column:
        n = F.length(s.text).cast("long")
        kept = F.transform(s.spans, lambda x, i: F.concat(
            piece(s, F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(s.spans, i - 1).end), x.start), x.label
        ))
        return F.concat(F.array_join(kept, ""), piece(s, F.get(s.spans, F.size(s.spans) - 1).end, n))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(text) / 4096).cast("int")),
        lambda k: F.substring(text, k * 4096 + 1, F.lit(4096)),
    )
    whole = let(F.struct(text.alias("text"), blocks.alias("blocks"), merged(spans).alias("spans")), masked)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def sanitised(docs: DataFrame, text_col: str = "text", rule: Disclosure = Disclosure()) -> DataFrame:
    """The rows with personal data masked, removed or generalised in the text; a null text stays null."""
    base = searched(docs, text_col, [c for c in docs.columns if c != text_col])
    more = second_layer(base, rule)
    both = base.join(more, "row", "left")
    spans = F.concat(
        F.transform("found", lambda f: F.struct(
            f.start.alias("start"), f.end.alias("end"), F.concat(F.lit("["), F.upper(f.kind), F.lit("]")).alias("label"))),
        F.coalesce(F.transform("more", lambda m: F.struct(
            m.start.alias("start"), m.end.alias("end"), F.when(m.kind == "term", "").otherwise("[WORD]").alias("label"))),
            F.array().cast("array<struct<start:bigint,end:bigint,label:string>>")),
    )
    text = _masked(F.col("text"), F.array_sort(spans))
    return both.select(*[
        (text if c == text_col else F.col("carried").getField(c)).alias(c) for c in docs.columns
    ])


def op1(docs: DataFrame) -> DataFrame:
    return found_spans(docs.select("doc_id", "text"))
