"""Personal data: patterns, and terms that disclose what the patterns protect, by corpus co-occurrence.

E-mail addresses, IP addresses, card and phone numbers are found by pattern. Each value found is a protected entity. A
term (a run of letters, marks and digits outside the pattern spans, of any length) discloses it as far as the term's
occurrence in the corpus points to the entity: the pointwise mutual information of the two, over the entity's own
information content, from the numbers of different texts that hold the term, the entity, and both, wherever in the text
they stand. In every text that holds the entity, each occurrence of the term is replaced by a general one at
``GENERALISE`` and removed at ``REMOVE``. All of it is DataFrame functions: regular expressions, joins, counts.

Results for odd input: null text counts as empty and has no span; offsets are code points, end exclusive; long runs are
matched in linear time; null and repeated ids keep their own rows (see ``coordinates``); equal texts count once as
evidence, and each of them has its spans; an entity that every text holds is disclosed by nothing; an empty table gives
no rows; extra columns are ignored by ``find_spans`` and kept by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import coordinates, cut, let, table

# The kinds in order, and their patterns. Possessive repeats and the guards on where a match may begin
# leave the matches as they are and keep the matcher linear.
KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}\p{M}\p{N}]++"

LEAST_TOGETHER = 2  # different texts that hold both term and entity
GENERALISE, REMOVE = 0.8, 0.95
_BLOCK = 64


def _matches(text: Column, pattern: str, guard: Column, offset: Column | None = None) -> Column:
    """array<struct<start, end, found>> of a pattern's matches, by code points. ``guard`` is a cheap necessary condition.

    The pieces between matches and the matches themselves give the places as running sums, added up in blocks.
    """
    def place(s: Column) -> Column:
        steps = F.transform(s["hits"], lambda h, i: (F.length(F.get(s["between"], i)) + F.length(h)).cast("long"))
        return let(steps, lambda a: let(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")),
                        lambda b: F.aggregate(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0).cast("long"), lambda x, y: x + y)),
            lambda sums: F.transform(s["hits"], lambda h, i: let(
                F.aggregate(F.slice(sums, F.lit(1), F.floor(i / _BLOCK).cast("int")), F.lit(0).cast("long"), lambda x, y: x + y)
                + F.aggregate(F.slice(a, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1), F.lit(0).cast("long"), lambda x, y: x + y)
                + (F.lit(0) if offset is None else offset),
                lambda end: F.struct((end - F.length(h)).cast("long").alias("start"), end.cast("long").alias("end"), h.alias("found"))))))

    both = F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return F.when(guard, let(both, lambda s: F.when(F.size(s["hits"]) > 0, place(s)).otherwise(none))).otherwise(none)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: str):
    def ip(m: Column) -> Column:
        return F.forall(F.split(m, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: F.when(F.length(q) > 3, False).when(
            F.length(q) == 0, True).otherwise(q.cast("int") <= 255)))

    def card(m: Column) -> Column:
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False))

    return {"email": lambda m: F.lit(True), "ip": ip, "card": card,
            "phone": lambda m: F.length(_digits(m)).between(9, 15)}[kind]


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, found>> sorted by start, then kind in the order of KINDS (kind is its index)."""
    sources = {"email": (EMAIL, F.contains(text, F.lit("@"))), "ip": (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
               "card": (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")), "phone": (PHONE, F.contains(text, F.lit("+")))}
    def of_kind(kind: str) -> Column:
        pattern, guard = sources[kind]
        valid, index = _valid(kind), F.lit(KINDS.index(kind))
        return F.transform(F.filter(_matches(text, pattern, guard), lambda s: valid(s["found"])),
                           lambda s: F.struct(s["start"].alias("start"), index.alias("kind"), s["end"].alias("end"), s["found"].alias("found")))

    found = [of_kind(kind) for kind in sources]
    return F.array_sort(F.concat(*found))


def _merged(spans: Column) -> Column:
    """Sorted spans (start, end, put), those that overlap as one."""
    def merge(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["put"].alias("put"))
        return F.when(F.coalesce(F.get(kept, F.size(kept) - 1)["end"] > s["start"], F.lit(False)), F.concat(
            F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(longer))).otherwise(F.concat(kept, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint,put:string>>"), merge)


def _replaced(text: Column, kept: Column, put) -> Column:
    """The text with ``put(span)`` in the place of each span of ``kept`` (sorted, apart, at least one)."""
    parts = F.transform(kept, lambda s, i: let(F.coalesce(F.get(kept, i - 1)["end"], F.lit(0)), lambda at: F.concat(
        F.substring(text, (at + 1).cast("int"), (s["start"] - at).cast("int")), put(s))))
    return F.concat(F.array_join(parts, ""), F.substring(text, (F.element_at(kept, -1)["end"] + 1).cast("int"), F.length(text)))


def _masked(text: Column, base: Column) -> Column:
    """The text with blanks in the place of its pattern spans (at least one), as long as before."""
    spans = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("").alias("put")))
    return let(_merged(spans), lambda kept: _replaced(text, kept, lambda s: F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int"))))


def _terms(text: Column) -> Column:
    """The hashes of a text's different terms."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(w)))


def _most_texts(total: int, with_entity: Column) -> Column:
    """The most texts a term may stand in to reach ``GENERALISE`` with an entity, a little generous in the last digit."""
    return (float(total) ** (1 - GENERALISE)) * F.pow(with_entity.cast("double"), F.lit(GENERALISE)) * (1 + 1e-9)


def _disclosure(total: int) -> Column:
    """Pointwise mutual information of term and entity over the entity's information content, at most 1."""
    pmi = F.log2(F.lit(float(total)) * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    return F.least(pmi / F.log2(F.lit(float(total)) / F.col("with_entity")), F.lit(1.0))


def find_spans(rows: DataFrame) -> DataFrame:
    """(at, doc_id, base, terms) for rows (at, doc_id, text): the pattern spans, and the disclosing terms' spans with
    their disclosure (0 to 1)."""
    spans = rows.select("at", "doc_id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                        base_spans(F.col("text")).alias("base"))
    found = cut(spans.withColumn("masked", F.when(F.size("base") > 0, _masked(F.col("text"), F.col("base")))).drop("text"))
    firsts = cut(found.groupBy("digest").agg(F.min(F.struct("at", F.col("masked").isNull().alias("plain"))).alias("f")).select("f.*"))  # a row of each text
    total = firsts.count()

    with_base = found.where(F.size("base") > 0)
    entities = with_base.select("at", F.explode(F.array_distinct(F.transform(
        "base", lambda s: F.xxhash64(s["kind"], F.lower(s["found"]))))).alias("entity"))
    shared = entities.join(firsts, "at", "left_semi").groupBy("entity").agg(F.count("*").alias("with_entity")).where(
        (F.col("with_entity") >= LEAST_TOGETHER) & (F.col("with_entity") < total))
    held = cut(entities.join(shared, "entity").groupBy("at").agg(F.collect_list(F.struct("entity", "with_entity")).alias("held")))
    holders = with_base.select("at", "masked").join(held, "at")
    # a term is counted where it stands outside the pattern spans, in the masked text of a row that has any
    seen = rows.select("at", "text").join(firsts.where("plain").hint("shuffle_hash"), "at", "left_semi").select(F.explode(_terms(F.col("text"))).alias("term"))
    beside = with_base.join(firsts, "at", "left_semi").select(F.explode(_terms(F.col("masked"))).alias("term"))
    per_term = seen.unionAll(beside).groupBy("term").agg(F.count("*").alias("with_term"))
    # both <= with_entity and both <= with_term bound a disclosure from above: terms that can't reach the level go before
    # they are paired, so common terms and terms of one text meet no entity
    widest = held.agg(F.max(F.expr("array_max(transform(held, h -> h.with_entity))"))).first()[0] or 0
    rare = per_term.where((F.col("with_term") >= LEAST_TOGETHER) & (F.col("with_term") <= _most_texts(total, F.lit(widest))))
    near = holders.select("at", F.explode(_terms(F.col("masked"))).alias("term")).join(rare, "term")
    pairs = cut(near.join(held, "at").select("at", "term", "with_term", F.explode(F.filter(
        "held", lambda h: F.col("with_term") <= _most_texts(total, h["with_entity"]))).alias("h")).select("at", "term", "with_term", "h.*"))
    together = pairs.join(firsts, "at", "left_semi").groupBy("entity", "with_entity", "term", "with_term").agg(
        F.count("*").alias("both")).where(F.col("both") >= LEAST_TOGETHER)
    telling = together.select("entity", "term", _disclosure(total).alias("disclosure")).where(F.col("disclosure") >= GENERALISE)
    hits = pairs.join(telling, ["entity", "term"]).groupBy("at", "term").agg(F.max("disclosure").alias("disclosure"))
    places = holders.select("at", F.explode(_matches(F.col("masked"), TERM, F.lit(True))).alias("w")).select(
        "at", F.xxhash64(F.lower("w.found")).alias("term"), "w.start", "w.end")
    terms = places.join(hits, ["at", "term"]).groupBy("at").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,disclosure:double>>")
    return found.select("at", "doc_id", "base").join(terms, "at", "left").select(
        "at", "doc_id", "base", F.coalesce("terms", empty).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _same_as(i: int):
    return lambda k: k == i


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts per kind, the digest of the pattern spans, and all spans, for every row."""
    found = find_spans(coordinates(docs, id_col, text_col))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end")))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, _same_as(i)), False)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.array_sort(F.concat(plain, terms))).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with every span in the text replaced: pattern spans by their kind, terms generalised or removed.

    Spans that overlap are replaced as one. A null text stays null. All columns are kept.
    """
    rows = coordinates(docs, id_col, text_col)
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(kinds, s["kind"]).alias("put")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
        s["disclosure"] >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]")).alias("put")))
    spans = find_spans(rows).select("doc_id", F.array_sort(F.concat(base, terms)).alias("__spans"), "at").where(F.size("__spans") > 0)

    # equal ids with different texts have different spans: the text is part of the key
    keyed = docs.withColumn("__id", F.col(id_col)).withColumn("__text", F.col(text_col)).withColumn("__hash", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    of_row = rows.select("at", F.xxhash64("text").alias("__hash")).join(spans, "at").select(
        F.col("doc_id").alias("__id2"), F.col("__hash").alias("__hash2"), "__spans").dropDuplicates(["__id2", "__hash2"])
    joined = keyed.join(of_row.hint("shuffle_hash"), F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__hash") == F.col("__hash2")), "left")
    clean = F.when(F.col("__spans").isNull() | F.col("__text").isNull(), F.col("__text")).otherwise(let(
        _merged(F.col("__spans")), lambda kept: _replaced(F.col("__text"), kept, lambda s: s["put"])))
    return joined.withColumn(text_col, clean).select(*docs.columns)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
