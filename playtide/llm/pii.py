"""Personal data: exact patterns, and terms that give them away.

The base finds e-mail and IP addresses, payment cards and phone numbers by pattern. The
values found are protected entities. A term in the words around an entity discloses it as
far as knowing the term tells which entity is meant: by point-wise mutual information,

    pmi(entity; term) = log2(N * n(entity, term) / (n(entity) * n(term))),

out of the entity's own information, log2(N / n(entity)). Counts are of different texts in the
whole corpus: all N, those with the entity, those with the term, and those with
both, however far apart; copies of a text count once. Terms that disclose at least ``DISCLOSURE``
of an entity's information are added as spans wherever they stand in the texts that mention it:
removed from ``REMOVE`` on, generalised to a category below. What decides is a smoothed share, with ``PRIOR`` more
texts of the entity and of the term: a value or a word of a single text counts in full, but in
a corpus of a few hundred different texts its meeting the other may be chance, and nothing is
hidden for it. Texts without personal data stay as they are.

Defined results: null and empty texts have no spans. Repeated rows get equal spans. Matches
that fail a check are dropped and not tried again from another start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready, stored, whole_text

PRIOR = 1 / 3  # of a text, added to the texts of an entity and of a term before a share decides
DISCLOSURE = 0.9  # share of an entity's information from which a term is hidden
REMOVE = 0.98
BITS = 1 << 20  # of the filter for terms; its size does not depend on the corpus

KINDS = ("email", "ip", "card", "phone", "term")
# Fixed patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}  # without it a text has no match

_WORD = re.compile(r"[^\W_]+")
_NOT_DIGIT = re.compile(r"[^0-9]")

SPANS = "array<struct<kind:string,start:int,stop:int>>"
TERMS = "array<struct<start:int,stop:int,share:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def passes(kind: str, match: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match.split("."))
    digits = _NOT_DIGIT.sub("", match)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, kind number, stop, value)`` of the patterns' matches that pass, by start and kind."""
    found = []
    for number, kind in enumerate(KINDS[:4]):
        if NEEDED[kind] in text:
            for match in PATTERNS[kind].finditer(text):
                if passes(kind, match.group()):
                    found.append((match.start(), number, match.end(), match.group()))
    return sorted(found)


def entity_of(kind: int, value: str) -> str:
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else value if kind == 1 else _NOT_DIGIT.sub('', value)}"


def free_words(text: str) -> Iterator[re.Match]:
    """The words of a text that are not part of an entity."""
    spans, at, stop = base_spans(text), 0, 0
    for word in _WORD.finditer(text):
        while at < len(spans) and spans[at][0] < word.end():
            stop = max(stop, spans[at][2])
            at += 1
        if stop <= word.start():
            yield word


def base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` (pattern spans) and ``entities`` to each row."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
    kinds = pa.struct([("base", pa.list_(span)), ("entities", pa.list_(pa.string()))])

    @F.arrow_udf(f"struct<base:{SPANS},entities:array<string>>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            rows = []
            for value in batch:
                spans = base_spans(value.as_py() or "")
                rows.append({"base": [{"kind": KINDS[k], "start": s, "stop": e} for s, k, e, _ in spans],
                             "entities": sorted({entity_of(k, v) for _, k, _, v in spans})})
            yield pa.array(rows, kinds)

    python_ready(docs.sparkSession)
    # Every pattern needs a digit or an @; texts with neither are not sent to Python.
    maybe = F.when(F.col(f"`{text}`").rlike("[@0-9]"), F.col(f"`{text}`")).otherwise("")
    return docs.withColumn("found", run(maybe)).select("*", "found.*").drop("found")


def disclosing(held: DataFrame, texts: DataFrame) -> DataFrame:
    """``(text_key, term, share)``: terms that disclose at least DISCLOSURE of the information of an entity of a text.

    ``held(text_key, entities, text)`` has each different text with entities once;
    ``texts(text_key, text)`` covers the whole corpus. The smoothed share decides; the one
    returned is that of the plain counts.
    """
    copies = stored(texts.groupBy("text_key").agg(F.count(F.lit(1)).alias("n")), "copies")
    total = float(max(copies.count(), 1))
    # No term of more texts than this can disclose so much of an entity of n texts.
    reach = lambda n: F.lit(total ** (1 - DISCLOSURE)) * F.pow(n, F.lit(DISCLOSURE))
    entities = held.select("text_key", F.explode("entities").alias("entity"))
    of_entity = stored(entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "entity-texts")
    # Entities of a single text have equal counts with its terms, so they are counted as one.
    owner = F.when(F.col("n_entity") > 1, F.col("entity")).otherwise(F.concat(F.lit("text:"), F.col("text_key")))
    owners = entities.join(of_entity, "entity").select("text_key", owner.alias("owner"), "n_entity").distinct()
    most = of_entity.agg(F.max("n_entity")).first()[0] or 0
    words = stored(held.select("text_key", F.explode(different_words("text")).alias("term")), "held-words")
    rare = words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= reach(F.lit(most))).select("term")
    of_term = stored(term_texts(different_texts(texts, copies.where("n > 1")), stored(rare, "rare-words"))
                     .where(F.col("n_term") <= reach(F.lit(most))), "term-texts")
    pairs = stored(words.join(of_term, "term").join(owners, "text_key").where(F.col("n_term") <= reach(F.col("n_entity"))),
                   "term-pairs")
    counted = pairs.groupBy("owner", "term", "n_entity", "n_term").agg(F.count(F.lit(1)).alias("n_both"))
    known = stored(counted.withColumn("share", shared(total, 0)).where(shared(total, PRIOR) >= DISCLOSURE)
                   .select("owner", "term", "share"), "known-terms")
    return pairs.join(known, ["owner", "term"]).groupBy("text_key", "term").agg(F.max("share").alias("share"))


def different_texts(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """Each different text once. Only texts that a filter of BITS bits takes for copies are shuffled."""
    place = F.pmod("text_key", F.lit(BITS)).alias("place")
    places = F.broadcast(stored(copies.select(place).distinct(), "copy-places"))
    placed = texts.withColumn("place", place)
    single = placed.join(places, "place", "left_anti").select("text")
    return single.union(placed.join(places, "place", "left_semi").dropDuplicates(["text_key"]).select("text"))


def different_words(text: str) -> Column:
    """The different words outside entities, in lower case."""
    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted({w.group().lower() for w in free_words(value.as_py())}) for value in batch],
                           pa.list_(pa.string()))

    return run(F.col(text))


def places(text: str, terms: str) -> Column:
    """Every place of ``terms(term, share)`` in a text, outside entities."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("share", pa.float64())]))

    @F.arrow_udf(TERMS)
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = []
        for value, terms in zip(texts, lists):
            share = {t["term"]: t["share"] for t in terms.as_py()}
            rows.append([{"start": w.start(), "stop": w.end(), "share": share[w.group().lower()]}
                         for w in free_words(value.as_py()) if w.group().lower() in share])
        return pa.array(rows, kind)

    return run(F.col(text), F.col(terms))


def shared(total: float, prior: float) -> Column:
    """The share of an entity's information that a term discloses, with ``prior`` more texts of either."""
    own = F.log2(F.lit(total) / F.col("n_entity"))
    pmi = F.log2(F.lit(total) * F.col("n_both") / ((F.col("n_entity") + prior) * (F.col("n_term") + prior)))
    return F.try_divide(pmi, own)


def term_texts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n_term)``: how many documents have each of the terms.

    A task keeps only words whose hash is a term's, by a filter of BITS bits, and adds them up
    before they are shuffled; the few others that pass the filter go in the join.
    """
    places = terms.select(F.pmod(F.xxhash64("term"), F.lit(BITS)).cast("int").alias("x")).distinct().toArrow()
    wanted = np.zeros(BITS, bool)
    wanted[places["x"].to_numpy()] = True
    packed = np.packbits(wanted)

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = np.unpackbits(packed).astype(bool)
        for batch in batches:
            yield pa.array([hits(value.as_py(), bits) for value in batch], pa.list_(pa.string()))

    seen = texts.select(F.explode(run("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    return seen.join(terms, "term")


def hits(text: str | None, bits: np.ndarray) -> list[str]:
    """The different words of a text, in lower case, whose hash is in the filter."""
    words = list({word.lower() for word in _WORD.findall(text or "")})
    places = [xxhash.xxh64_intdigest(word, 42) % len(bits) for word in words]
    return [words[i] for i in np.flatnonzero(bits[places])] if words else []


def protect(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id, text_key, base, terms``: the spans of each document; ``text_key`` is a hash of its text."""
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text")).withColumn(
        "text_key", F.xxhash64("text"))
    found = stored(base(texts).withColumn("text", F.when(F.size("entities") > 0, F.col("text"))), "entities")
    none = F.col("text").isNull()
    held = stored(found.where(~none).select("text_key", "entities", "text").dropDuplicates(["text_key"]), "held-texts")
    known = disclosing(held, texts.select("text_key", "text")).groupBy("text_key").agg(
        F.collect_list(F.struct("term", "share")).alias("known"))
    terms = stored(held.join(known, "text_key").select("text_key", places("text", "known").alias("terms")), "terms")
    empty = F.array().cast(TERMS)
    columns = [F.col("id").alias(id_column), "text_key", "base"]
    return found.where(none).select(*columns, empty.alias("terms")).union(
        found.where(~none).join(terms, "text_key", "left").select(*columns, F.coalesce("terms", empty).alias("terms")))


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of spans, by start, then kind in the order of KINDS."""
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("b"),
        F.concat_ws(":", s["kind"], s["start"], s["stop"]).alias("c")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: s["c"]), ",")


def all_spans() -> Column:
    """The base and term spans of a row of ``protect``."""
    return F.concat("base", F.transform("terms", lambda t: F.struct(
        F.lit("term").alias("kind"), t["start"].alias("start"), t["stop"].alias("stop"))))


def cleaned(text: str, base: list[dict], terms: list[dict]) -> str:
    """The text with base spans and terms replaced by their category, the most telling terms removed."""
    spans = [(s["start"], s["stop"], f"[{s['kind']}]") for s in base]
    for t in terms:
        word = text[t["start"]:t["stop"]]
        category = "[number]" if word.isdigit() else "[name]" if word[:1].isupper() else "[word]"
        spans.append((t["start"], t["stop"], "" if t["share"] >= REMOVE else category))
    out, at = [], 0
    for start, stop, sign in sorted(spans):
        if stop > at:
            out += [text[at:start], sign]
            at = stop
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents with personal data and disclosing terms taken out of their texts."""
    spans = (protect(docs, text, id_column).select(F.col(id_column).alias("__id"), F.col("text_key").alias("__key"),
                                                   F.col("base").alias("__base"), F.col("terms").alias("__terms"))
             .where("size(__base) > 0").dropDuplicates(["__id", "__key"]))

    @F.arrow_udf("string")
    def run(texts: pa.Array, base: pa.Array, terms: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), base.to_pylist(), terms.to_pylist())
        return pa.array([t if b is None else cleaned(t, b, x) for t, b, x in rows], pa.string())

    same = (F.xxhash64(whole_text(text)) == F.col("__key")) & F.col(f"`{id_column}`").eqNullSafe(F.col("__id"))
    return (docs.join(spans, same, "left").withColumn(text, run(F.col(f"`{text}`"), "__base", "__terms"))
            .drop("__id", "__key", "__base", "__terms"))
