"""Personal data: fixed forms, and terms that reveal them; built-in functions only.

Addresses and numbers of four kinds are found by pattern and checked. The words around them are then
counted over the corpus: with how many different contexts of one entity a word occurs, and in how many
texts at all. A word by which an entity can be guessed (most of its texts hold the entity, and
the entity is many times likelier with it than without) discloses it as well. Such terms are
generalised to their kind, and removed where they say more than ``REMOVE_BITS`` about the entity.

Contexts are small rows of the texts that hold an entity; only candidate terms are counted over all
words, and they and the final terms are joined, so that Spark broadcasts them by their stored size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.scratch import materialize

SUPPORT = 5  # different contexts in which a term stands by one entity
CERTAINTY = 0.5  # share of a term's texts that hold the entity
BITS = 6.0  # information of a term about an entity from which it is a span
REMOVE_BITS = 12.0  # and from which it is removed, not generalised
AROUND = 60  # code points on either side of an entity that are its context
SHORTEST = 3  # letters of a term

# The kinds in order, with their patterns. Possessive quantifiers and the conditions on
# what stands before a match change no match; they keep long runs linear.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = "term"
_BYTE = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
_SPAN = "struct<start:int,place:int,stop:int,kind:string,found:string>"


def _matches(text: Column, pattern: Column, kind: str) -> Column:
    """Spans of all matches; starts follow from the lengths of the matches and of what lies between."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.zip_with(between, found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    place = F.lit([*KINDS, TERM].index(kind))

    def step(state, part):
        start = state.at + part.gap
        stop = start + F.length(part.hit)
        span = F.struct(start.alias("start"), place.alias("place"), stop.alias("stop"), F.lit(kind).alias("kind"), part.hit.alias("found"))
        return F.struct(stop.alias("at"), F.array_append(state.spans, span).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    return F.aggregate(F.filter(parts, lambda p: p.hit.isNotNull()), zero, step, lambda state: state.spans)


def luhn(digits: Column) -> Column:
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans (start, place, stop, kind, found) of the fixed kinds by start and kind; code points, end exclusive."""
    text = F.coalesce(text, F.lit(""))
    # Cheap conditions first: few texts hold any of the kinds.
    hints = {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
        "phone": text.contains("+"),
    }
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    checks = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: F.forall(F.split(s.found, r"\."), lambda p: p.rlike(_BYTE)),
        "card": lambda s: luhn(digits(s.found)),
        "phone": lambda s: F.length(digits(s.found)).between(9, 15),
    }
    none = F.array().cast(f"array<{_SPAN}>")
    found = [F.when(hints[k], F.filter(_matches(text, F.lit(PATTERNS[k]), k), checks[k])).otherwise(none) for k in KINDS]
    return F.array_sort(F.concat(*found))


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= SHORTEST)


def _contexts(rows: DataFrame) -> DataFrame:
    """(content, entity, kind, context, term) around the spans of the texts that hold any."""
    spans = rows.select("content", "text", base_spans(F.col("text")).alias("spans")).filter(F.size("spans") > 0)
    each = spans.select("content", "text", F.explode("spans").alias("s"))
    start, stop = F.col("s.start"), F.col("s.stop")
    before = F.substring("text", F.greatest(start - AROUND, F.lit(0)) + 1, F.least(start, F.lit(AROUND)))
    after = F.substring("text", stop + 1, F.lit(AROUND))
    before = F.when(start > AROUND, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
    after = F.when(F.length(after) == AROUND, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
    each = each.select(
        "content", F.xxhash64("s.kind", F.lower("s.found")).alias("entity"), F.col("s.kind").alias("kind"),
        F.xxhash64(before, after).alias("context"), F.array_distinct(F.concat(_terms(before), _terms(after))).alias("terms"),
    )
    return each.select("content", "entity", "kind", "context", F.explode_outer("terms").alias("term"))


def disclosing_terms(
    docs: DataFrame, text_col: str = "text", *, support: int = SUPPORT, certainty: float = CERTAINTY, bits: float = BITS
) -> DataFrame:
    """(term, kind, bits): the words by which an entity of the corpus can be guessed.

    Repeated texts count once. Counts cover all rows.
    """
    rows = docs.select(F.xxhash64(text_col).alias("content"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    contexts = materialize(_contexts(rows), "contexts")
    entities = contexts.groupBy("entity").agg(F.countDistinct("content").alias("n_entity"))
    terms = contexts.dropna(subset=["term"])
    pairs = terms.groupBy("entity", "kind", "term").agg(F.countDistinct("context").alias("n_pair"), F.countDistinct("content").alias("n_both"))
    # A term is in as many texts at least as by entities, so one that is by many others cannot be certain.
    around = terms.groupBy("term").agg(F.countDistinct("content").alias("n_around"))
    pairs = pairs.filter(F.col("n_pair") >= support).join(around, "term").filter(F.col("n_both") / F.col("n_around") >= certainty)
    pairs = materialize(pairs.join(entities, "entity"), "term-candidates")
    candidates = materialize(pairs.select("term").distinct(), "candidates")
    words = rows.select("content", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    counted = words.join(candidates, "term", "left_semi").groupBy("term").agg(F.countDistinct("content").alias("n_term"))
    total = rows.select("content").distinct().count()
    share = F.col("n_both") / F.col("n_term")
    known = pairs.join(counted, "term").withColumn("bits", F.log2(share * F.lit(total) / F.col("n_entity")))
    strong = known.filter((share >= certainty) & (F.col("bits") >= bits))
    best = strong.groupBy("term").agg(F.max(F.struct("bits", "kind")).alias("best"))
    return materialize(best.select("term", "best.kind", "best.bits"), "disclosing-terms")


_ADDED = ("text", "base", "terms", "held", "content")


def free_prefix(docs: DataFrame) -> str:
    """A prefix under which the columns that ``with_spans`` adds clash with none of ``docs``."""
    taken, prefix = {c.lower() for c in docs.columns}, "pii"
    while any(f"{prefix}_{c}" in taken for c in _ADDED):
        prefix += "_"
    return prefix


def with_spans(docs: DataFrame, text_col: str = "text", prefix: str = "pii", **limits) -> DataFrame:
    """All columns of ``docs``, and ``pii_text`` (null as empty), ``pii_base`` and ``pii_terms``.

    The spans of ``pii_terms`` have kind ``term`` and, as ``found``, what they are generalised to ('' to
    remove them); those that touch a base span are left out. ``limits`` are those of ``disclosing_terms``.
    Another ``prefix`` (see ``free_prefix``) gives other names; names that ``docs`` has already are an error.
    """
    whole, base, found, hidden, content = (f"{prefix}_{c}" for c in _ADDED)
    if clash := {c.lower() for c in docs.columns} & {whole, base, found, hidden, content}:
        raise ValueError(f"the documents have columns of the names {', '.join(sorted(clash))}")
    terms = disclosing_terms(docs, text_col, **limits)
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.xxhash64(text_col).alias("content"), F.explode(F.array_distinct(_terms(text))).alias("term"))
    shown = F.when(F.col("bits") >= REMOVE_BITS, "").otherwise(F.concat(F.lit("["), "kind", F.lit(" hint]")))
    held = words.join(terms, "term").groupBy("content").agg(F.map_from_entries(F.collect_set(F.struct("term", shown))).alias(hidden))
    held = materialize(held.withColumnRenamed("content", content), "texts-with-terms")
    rows = docs.withColumn(whole, text)
    both = rows.join(held, F.xxhash64(text_col) == F.col(content), "left").withColumn(base, base_spans(F.col(whole)))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.map_keys(hidden), "|"), F.lit(r")(?!\p{L})"))
    spans = F.when(F.col(hidden).isNotNull(), _matches(F.col(whole), pattern, TERM)).otherwise(F.array().cast(f"array<{_SPAN}>"))
    free = F.filter(spans, lambda s: ~F.exists(base, lambda b: (s.start < b.stop) & (b.start < s.stop)))
    named = F.transform(free, lambda s: s.withField("found", F.coalesce(F.element_at(hidden, F.lower(s.found)), F.lit(""))))
    return both.withColumn(found, named).drop(hidden, content)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(id, text, base, terms) for every row: spans of the fixed kinds, and of disclosing terms.

    Null texts count as empty, repeated rows give a row each, null ids stay null, an empty table gives no
    rows; see ``with_spans``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = with_spans(rows, "text", **limits)
    return found.select("id", F.col("pii_text").alias("text"), F.col("pii_base").alias("base"), F.col("pii_terms").alias("terms"))


def span_list(spans: Column) -> Column:
    """'kind:start:end' of each span, by start and kind, joined by commas."""
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string")))
    return F.array_join(text, ",")


def sanitised(text: str, base: str, terms: str) -> Column:
    """The text with its spans replaced: base kinds and generalised terms by a label, others by nothing."""
    label = lambda s: F.when(s.kind == TERM, s.found).otherwise(F.concat(F.lit("["), F.upper(s.kind), F.lit("]")))
    spans = F.array_sort(F.concat(base, terms))
    cut = "struct<from:int,start:int,label:string>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{cut}>").alias("cuts"))

    def step(state, s):
        # What begins inside the span before goes with it.
        piece = F.struct(state.at.alias("from"), s.start.alias("start"), label(s).alias("label"))
        cuts = F.when(s.start >= state.at, F.array_append(state.cuts, piece)).otherwise(state.cuts)
        return F.struct(F.greatest(state.at, s.stop).alias("at"), cuts.alias("cuts"))

    def render(state):
        pieces = F.transform(state.cuts, lambda c: F.concat(F.substring(text, c["from"] + 1, c.start - c["from"]), c.label))
        return F.concat(F.array_join(pieces, ""), F.substring(text, state.at + 1, F.length(text)))

    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, zero, step, render))


def sanitise(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with personal data and disclosing terms in its texts replaced or removed; null stays null.

    Other columns stay as they are, whatever their names; texts may be of any length, rows may repeat.
    """
    prefix = free_prefix(docs)
    found = with_spans(docs, text_col, prefix, **limits)
    clean = F.when(F.col(text_col).isNotNull(), sanitised(*(f"{prefix}_{c}" for c in ("text", "base", "terms"))))
    return found.withColumn(text_col, clean).select(*docs.columns)
