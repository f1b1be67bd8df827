"""Personal data by patterns and by information-theoretic sanitisation, in DataFrame and SQL functions only.

Patterns give the base spans (email, ip, card, phone), leftmost and without overlap in each kind.

Sanitisation then looks for terms that disclose such an entity once the entity itself is masked. Everything is counted over
passages, a text's stretches of ``PASSAGE_CHARS`` code points; what begins in a stretch belongs to it. A term is a word of letters,
lower-cased (a run of letters that goes on for more than PASSAGE_CHARS behind its passage is cut there). Over all passages of the
corpus, n(t) counts those with the term, n(e) those with the entity and n(t, e) those with both; copies count each. With IC(e) = -log2(n(e) / N) and PMI(t, e) = log2(N n(t, e) / (n(t) n(e))), the term
discloses the share PMI / IC of the entity: 1 where the entity follows from the term, also for an entity that occurs once, where the
share is 1 - log n(t) / log N.

* From ``REMOVE`` on a term is removed.
* From ``GENERALISE`` on it is generalised to a class: its longest prefix of ``CLASS_LETTERS`` letters or more whose terms together
  disclose less than ``GENERALISE`` of that entity. A term without such a class is removed.
* A term that discloses several entities is treated as the strictest asks: removed, else the shortest class.

Every place of such a term, in whichever text, is a span of kind ``term`` unless it overlaps a base span there.

Null texts are empty. Rows are told apart by doc_id and text; repeated rows share their spans. A null doc_id is a key of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeline.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. A match of the first two starts where a run of its first class starts, or where the last match
#: ended; saying so, and the possessive repeats, keep the search linear in long runs and change no match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to match at all; checked before the pattern runs.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
PASSAGE_CHARS = 256
#: Shares of an entity's information content from which a term is generalised, and from which it is removed.
GENERALISE = 0.75
REMOVE = 0.95
CLASS_LETTERS = 3
#: Disclosing terms up to which they are broadcast (a term is PASSAGE_CHARS letters at most); beyond that texts' words are shuffled to them.
BROADCAST_TERMS = 200_000
_LETTERS = r"\p{L}+"
#: A passage, and the letters that follow it where it ends within a word.
_PASSAGE = rf"(?s)(.{{1,{PASSAGE_CHARS}}})(?=((?<=\p{{L}})\p{{L}}{{0,{PASSAGE_CHARS}}}+|))"
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
_TERMS = "array<struct<start:int,end:int,term:string,put:string>>"


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.substr(F.concat(F.lit("000"), p), F.char_length(p) + 1, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.char_length(digits).between(10, 15)


def _scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of whole numbers from 0 on, by an associative ``op``.

    An array that grows by one in each step is copied in each: long ones are therefore taken in stretches of the square root of their length, and
    the stretches' totals are added on.
    """
    lists = "struct<at:int,out:array<int>>"

    def plain(v: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")).cast(lists)

        def step(acc: Column, x: Column) -> Column:
            now = op(acc["at"], x)
            return F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out"))

        return F.aggregate(v, begin, step)["out"]

    def long(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        parts = F.transform(F.sequence(F.lit(1), F.size(v), width), lambda s: F.slice(v, s, width))
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), op))
        # each stretch starts from the total before it
        before = plain(totals, F.lit(0))
        starts = F.concat(F.array(F.lit(0)), F.slice(before, F.lit(1), F.size(before) - 1))
        return F.flatten(F.transform(F.arrays_zip(parts.alias("p"), starts.alias("s")), lambda z: plain(z["p"], z["s"])))

    # as a variable, so that what makes the values is worked out once
    return F.get(F.transform(F.array(values), lambda v: F.when(F.size(v) <= 64, plain(v, F.lit(0))).otherwise(long(v))), F.lit(0))


def _kind_spans(kind: str, rank: int):
    """A function from a struct {v: matches, p: pieces between them} to the spans of a kind.

    split() and regexp_extract_all() see the same matches, so lengths of pieces and matches add up to places.
    """
    none = F.array().cast(_SPANS)

    def of(x: Column) -> Column:
        n = F.size(x["v"])
        lengths = F.zip_with(F.slice(x["p"], F.lit(1), n), x["v"], lambda p, v: F.char_length(p) + F.char_length(v))
        parts = F.arrays_zip(x["v"].alias("v"), _scan(lengths, lambda a, b: a + b).alias("e"))

        def span(m: Column) -> Column:
            return F.struct((m["e"] - F.char_length(m["v"])).alias("start"), F.lit(rank).alias("rank"), m["e"].alias("end"), F.lit(kind).alias("kind"), m["v"].alias("value"))

        return F.when(n > 0, F.filter(F.transform(parts, span), lambda s: _valid(kind, s["value"]))).otherwise(none)

    return of


def spans_of(text: Column) -> Column:
    """Base spans of a text, ordered by start, then kind."""
    found, none = [], F.array().cast(_SPANS)
    for rank, kind in enumerate(KINDS):
        values, pieces = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.split(text, PATTERNS[kind], -1)
        spans = F.get(F.transform(F.array(F.struct(values.alias("v"), pieces.alias("p"))), _kind_spans(kind, rank)), F.lit(0))
        need = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
        found.append(F.when(need, spans).otherwise(none))
    return F.array_sort(F.concat(*found))


def _passages(text: Column) -> Column:
    """array<struct<own, rest, skip>>: passages, the rest of the word at each one's end, and the letters at its beginning that
    belong to a word begun before."""
    own, rest = F.regexp_extract_all(text, F.lit(_PASSAGE), F.lit(1)), F.regexp_extract_all(text, F.lit(_PASSAGE), F.lit(2))
    skip = F.transform(F.concat(F.array(F.lit("")), rest), lambda r: F.char_length(r))
    return F.arrays_zip(own.alias("own"), rest.alias("rest"), F.slice(skip, F.lit(1), F.size(own)).alias("skip"))


def _reading(p: Column) -> Column:
    """The stretch of a passage in which its words stand whole."""
    own = F.substr(p["own"], p["skip"] + 1)
    return F.when(F.char_length(own) > 0, F.concat(own, p["rest"])).otherwise(F.lit(""))


def _words(p: Column) -> Column:
    """Distinct terms of a passage."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_reading(p), F.lit(_LETTERS), F.lit(0)), F.lower))


def _places(p: Column, number: Column) -> Column:
    """array<struct<term, start, end>> of a passage's words in code points of the text."""
    text = _reading(p)
    words, gaps = F.regexp_extract_all(text, F.lit(_LETTERS), F.lit(0)), F.split(text, _LETTERS, -1)
    pairs = F.arrays_zip(words.alias("w"), F.slice(gaps, F.lit(1), F.size(words)).alias("g"))
    empty = F.struct((number * PASSAGE_CHARS + p["skip"]).cast("int").alias("at"), F.array().cast("array<struct<term:string,start:int,end:int>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.char_length(m["g"])
        end = start + F.char_length(m["w"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(F.lower(m["w"]).alias("term"), start.alias("start"), end.alias("end")))).alias("out"))

    return F.aggregate(pairs, empty, step)["out"]


def _print(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _based(docs: DataFrame) -> DataFrame:
    """(doc_id, print, spans, contexts) of the rows that have base spans; contexts: (entity, terms) of every passage with the entity."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", "text", _print().alias("print"), spans_of(text).alias("spans")).filter(F.size("spans") > 0)
    # strings, whose duplicates are found by hash: passage number and entity
    at = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", F.floor(s["start"] / PASSAGE_CHARS).cast("string"), s["kind"], F.lower(s["value"]))))
    found = found.select("doc_id", "print", "spans", at.alias("at"), _passages(F.col("text")).alias("passages"))
    number = lambda a: F.substring_index(a, ":", 1).cast("int")
    entity = lambda a: F.substr(a, F.instr(a, ":") + 1)
    contexts = F.transform("at", lambda a: F.struct(entity(a).alias("entity"), _words(F.get("passages", number(a))).alias("terms")))
    return written(found.select("doc_id", "print", "spans", contexts.alias("contexts")))


def _prefixes(term: str = "term") -> Column:
    """Explodes a term's prefixes of CLASS_LETTERS letters or more, itself left out."""
    n = F.char_length(term)
    lengths = F.when(n > CLASS_LETTERS, F.sequence(F.lit(CLASS_LETTERS), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.explode(F.transform(lengths, lambda k: F.left(F.col(term), k)))


def disclosing_terms(docs: DataFrame, based: DataFrame) -> DataFrame:
    """(term, put) of the terms that disclose an entity: ``put`` is what stands for the term, empty where it is removed."""
    contexts = based.select(F.explode("contexts").alias("c"))
    entities = written(contexts.groupBy("c.entity").agg(F.count("*").alias("n_entity")))
    together = written(contexts.select("c.entity", F.explode("c.terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both")))
    # Each passage counts once for each of its terms, and once under the empty term, which gives N.
    passages = docs.select(F.explode(_passages(F.col("text"))).alias("p"))
    terms = passages.select(F.explode(F.concat(F.array(F.lit("")), _words(F.col("p")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    terms = written(terms)
    total = terms.filter("term = ''").first()
    total = float(total.n_term) if total else 0.0

    def share(both: Column, many: Column) -> Column:
        ic = -F.log2(F.col("n_entity") / F.lit(total))
        return F.when(ic > 0, F.log2(F.lit(total) * both / (many * F.col("n_entity"))) / ic).otherwise(F.lit(0.0))

    pairs = together.join(entities, "entity").join(terms, "term").withColumn("share", share(F.col("n_both"), F.col("n_term"))).filter(F.col("share") >= GENERALISE)
    pairs = written(pairs.select("entity", "term", "n_entity", "share"))
    # Classes of the terms to be generalised: mentions of all terms with a prefix, in the corpus and beside the entity.
    asked = pairs.filter(F.col("share") < REMOVE).select("entity", "term", "n_entity", _prefixes().alias("class"))
    mentions = terms.select("n_term", _prefixes().alias("class")).join(asked.select("class").distinct(), "class", "left_semi").groupBy("class").agg(F.sum("n_term").alias("n_class"))
    beside = together.select("entity", "n_both", _prefixes().alias("class")).join(asked.select("entity", "class").distinct(), ["entity", "class"], "left_semi").groupBy("entity", "class").agg(F.sum("n_both").alias("n_beside"))
    classes = (
        asked.join(mentions, "class")
        .join(beside, ["entity", "class"])
        .filter(share(F.least("n_beside", "n_entity"), F.col("n_class")) < GENERALISE)
        .groupBy("entity", "term")
        .agg(F.max(F.char_length("class")).alias("letters"))
    )
    # 0 letters stand for removal, the strictest
    letters = F.when(F.col("share") < REMOVE, F.coalesce("letters", F.lit(0))).otherwise(F.lit(0))
    told = pairs.join(classes, ["entity", "term"], "left").groupBy("term").agg(F.min(letters).alias("letters"))
    return written(told.select("term", F.when(F.col("letters") > 0, F.concat(F.expr("left(term, letters)"), F.lit("*"))).otherwise(F.lit("")).alias("put")))


def found_spans(docs: DataFrame) -> DataFrame:
    """(d, p, spans, terms), once for each doc_id and print of the rows that have base spans or disclosing terms. Written."""
    docs = docs.select("doc_id", "text")
    based = _based(docs)
    told = disclosing_terms(docs, based)
    told = F.broadcast(told) if told.count() <= BROADCAST_TERMS else told
    # a passage's words are found first; only words that are told of are placed
    places = (
        docs.select("doc_id", _print().alias("print"), F.posexplode(_passages(F.col("text"))).alias("number", "p"))
        .select("doc_id", "print", "number", "p", F.explode(_words(F.col("p"))).alias("term"))
        .join(told, "term")
        .select("doc_id", "print", "term", "put", F.explode(F.filter(_places(F.col("p"), F.col("number")), lambda t: t["term"] == F.col("term"))).alias("t"))
        .select("doc_id", "print", "term", "put", "t.start", "t.end")
        .distinct()
    )
    # written, or the join below would be pushed under the one above and see every word of the corpus
    places = written(places)
    # A base span is listed in the passages it touches and two before: a term is less than two passages long.
    cells = F.explode(F.sequence(F.floor(F.col("s.start") / PASSAGE_CHARS) - 2, F.floor((F.col("s.end") - 1) / PASSAGE_CHARS)))
    taken = based.select(F.col("doc_id").alias("d"), F.col("print").alias("p"), F.explode("spans").alias("s")).select("d", "p", F.col("s.start").alias("a"), F.col("s.end").alias("b"), cells.alias("cell"))
    clash = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("print") == F.col("p"), F.floor(F.col("start") / PASSAGE_CHARS) == F.col("cell"), (F.col("a") < F.col("end")) & (F.col("start") < F.col("b"))]
    terms = places.join(taken, clash, "left_anti").groupBy("doc_id", "print").agg(F.array_sort(F.collect_list(F.struct("start", "end", "term", "put"))).alias("terms"))
    either = based.select("doc_id", "print", "spans", F.lit(None).cast(_TERMS).alias("terms")).unionByName(terms.select("doc_id", "print", F.lit(None).cast(_SPANS).alias("spans"), "terms"))
    one = either.groupBy(F.col("doc_id").alias("d"), F.col("print").alias("p")).agg(F.first("spans", ignorenulls=True).alias("spans"), F.first("terms", ignorenulls=True).alias("terms"))
    return written(one.select("d", "p", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"), F.coalesce("terms", F.array().cast(_TERMS)).alias("terms")))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term, n_removed (of the term spans)."""
    rows = docs.select("doc_id", _print().alias("print"))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base, terms = F.coalesce(F.col("spans"), F.array().cast(_SPANS)), F.coalesce(F.col("terms"), F.array().cast(_TERMS))
    extra = F.transform(terms, lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("term").alias("kind")))
    every = F.array_sort(F.concat(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))), extra))
    return rows.join(found_spans(docs), rows["doc_id"].eqNullSafe(F.col("d")) & (rows["print"] == F.col("p")), "left").select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.transform(base, told), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(every, told), ",").alias("spans"),
        F.size(terms).cast("long").alias("n_term"),
        F.size(F.filter(terms, lambda t: t["put"] == "")).cast("long").alias("n_removed"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans replaced by ``[KIND]`` and disclosing terms generalised to their class (``wald*``) or left out."""
    found = found_spans(docs)
    # a struct of all columns, so that none of the caller's names can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select("row", F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("print"))
    joined = rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p")), "left")
    cuts = F.array_sort(
        F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put"))),
            F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["put"].alias("put"))),
        )
    )
    grid = F.regexp_extract_all("row.text", F.lit(rf"(?s).{{1,{PASSAGE_CHARS}}}"), F.lit(0))
    joined = joined.select("row", F.when(F.size("spans") + F.size("terms") > 0, F.struct(cuts.alias("cuts"), grid.alias("grid"))).alias("made"))

    def between(a: Column, b: Column) -> Column:
        """The text from a to b, read from the passages that hold it."""
        i, j = F.floor(a / PASSAGE_CHARS).cast("int"), F.floor((b - 1) / PASSAGE_CHARS).cast("int")
        return F.when(b > a, F.substr(F.array_join(F.slice("made.grid", i + 1, j - i + 1), ""), a - i * PASSAGE_CHARS + 1, b - a)).otherwise(F.lit(""))

    # a span that overlaps an earlier one lies inside what is already replaced, or extends it
    ends = F.transform("made.cuts", lambda c: c["end"])
    joined = joined.select("row", "made", F.when(F.col("made").isNotNull(), _scan(ends, lambda a, b: F.greatest(a, b))).alias("ends"))
    before = F.concat(F.array(F.lit(0)), F.slice("ends", F.lit(1), F.size("ends") - 1))
    parts = F.filter(F.arrays_zip(F.col("made.cuts").alias("c"), before.alias("at")), lambda z: z["c"]["start"] >= z["at"])
    parts = F.transform(parts, lambda z: F.struct(z["at"].alias("a"), z["c"]["start"].alias("b"), z["c"]["put"].alias("put")))
    joined = joined.select("row", "made", F.when(F.col("made").isNotNull(), F.struct(parts.alias("parts"), F.element_at("ends", -1).alias("at"))).alias("cut"))
    text = F.concat(F.array_join(F.transform("cut.parts", lambda c: F.concat(between(c["a"], c["b"]), c["put"])), ""), between(F.col("cut.at"), F.char_length("row.text")))
    new = F.when(F.col("made").isNotNull(), text).otherwise(F.col("row.text"))
    return joined.select(*[new.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
