"""License scan: an exact set-similarity join of text blocks with license templates.

Blocks are windows of a text's words, wherever its lines and paragraphs end: for a template
of up to ``0.8 * span`` words they are ``2 * span`` words long and start every ``span`` words,
for the smallest such span of 24, 96, 384, ... Any ``span`` consecutive words stand whole in
one of them, so a notice is found however it is wrapped, quoted as a comment or joined to
other text, and a long line does not gather a template from words far apart.

A block contains a template if at least ``threshold`` of the template's distinct words are in
it, among them those that name the license, where the template has them. Words are ordered by
their frequency in the whole corpus, rarest first; only template words matter, as no other
word can overlap. A pair of block and template that meets the threshold shares
``need = ceil(threshold * |template|)`` words, so

* prefix filter: they share one of the first ``|x| - need + 1`` words of both sides,
* length filter: the block has ``need`` template words at least,
* positional filter: the words before, at and after a shared word leave room for ``need``.

Pairs that pass are verified by counting the overlap. Templates are a parameter of fixed
size, so their words and index go to all tasks. Beside the join, fixed phrases are searched
word by word in every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, materialise, quoted, slices, table, utf8
from .license_texts import NAMES, NOTICES, TEXTS

#: Fixed phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices and whole license texts, by label.
TEMPLATES = {label: NOTICES.get(label, ()) + TEXTS.get(label, ()) for label in sorted({*NOTICES, *TEXTS})}
THRESHOLD = 0.8
#: Smallest span, the factor to the next one, and the share of a span that a template may take.
SPAN, SPAN_FACTOR, SPAN_FILL = 24, 4, 0.8

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Bytes of words (A-Z lower-cased) stay, all others become blanks.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The words of a text: runs of digits, letters and characters beyond ASCII."""
    return text.translate(_FOLD).split()


class Template(NamedTuple):
    label: str
    words: frozenset[bytes]
    required: frozenset[bytes]
    span: int


def template_sets(templates: Mapping[str, tuple[str, ...]], names: Mapping[str, str]) -> list[Template]:
    found = []
    for label, texts in templates.items():
        for t in texts:
            seq, span = words(t.encode()), SPAN
            while SPAN_FILL * span < len(seq):
                span *= SPAN_FACTOR
            found.append(Template(label, frozenset(seq), frozenset(seq) & frozenset(words(names.get(label, "").encode())), span))
    return found


def block_starts(n: int, span: int) -> range:
    """First words of the blocks of a text of ``n`` words."""
    return range(0, max(n - span, 1), span) if n else range(0)


def token_frequencies(docs: DataFrame, text_col: str, tokens: frozenset[bytes]) -> dict[bytes, int]:
    """How often each of ``tokens`` (a set of fixed size) stands in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for t in utf8(part.column("text")):
                    seen.update(filter(tokens.__contains__, words(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    parts = map_arrow(docs.select(quoted(text_col).alias("text")), count, "token binary, n long")
    return {t: 0 for t in tokens} | {bytes(r["token"]): r["n"] for r in parts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def _phrase_hits(text: list[bytes], phrases: Mapping[bytes, str]) -> tuple[int, int | None, int | None, list[str]]:
    """(places, smallest start, largest start, labels) of the phrases in a word list."""
    joined = b" " + b" ".join(text) + b" "
    starts, labels = [], []
    for phrase, label in phrases.items():
        at = joined.find(phrase)
        if at >= 0:
            labels.append(label)
        while at >= 0:
            starts.append(at)
            at = joined.find(phrase, at + 1)
    if not starts:
        return 0, None, None, []
    return len(starts), joined.count(b" ", 0, min(starts)), joined.count(b" ", 0, max(starts)), labels


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
         phrases: Mapping[str, str] = PHRASES, threshold: float = THRESHOLD, names: Mapping[str, str] = NAMES) -> DataFrame:
    """Phrase places, template labels and score for each row of ``docs``.

    ``score`` is 1 if a phrase stands in the text, else the largest containment of a template
    in one block among those found, else 0; ``n_template_blocks`` counts the blocks that hold
    a template. A null text has no words; repeated rows come back as often; an empty table
    gives no rows; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    sets = template_sets(templates, names)
    vocabulary = frozenset().union(*(t.words for t in sets))
    seen = token_frequencies(docs, text_col, vocabulary)
    rank = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (seen[t], t)))}
    ordered = [(t, sorted(rank[w] for w in t.words), ceil(threshold * len(t.words) - 1e-9)) for t in sets]
    classes = []  # (span, words, prefix words, least overlap) of the templates of each span
    for span in sorted({t.span for t in sets}):
        mine = [(t.words, frozenset(r[: len(r) - need + 1]), need) for t, r, need in ordered if t.span == span]
        of_span, prefix = (frozenset().union(*part) for part in list(zip(*mine, strict=True))[:2])
        classes.append((span, of_span, frozenset(w for w in of_span if rank[w] in prefix), min(need for *_, need in mine)))
    wanted = {b" " + b" ".join(words(p.encode())) + b" ": label for p, label in phrases.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for t in utf8(part.column("text")):
                    found = words(t)
                    distinct, blocks = frozenset(found), []
                    for span, of_span, prefix, least in classes:
                        if prefix.isdisjoint(distinct):
                            continue
                        for a in block_starts(len(found), span):
                            inside = of_span.intersection(found[a: a + 2 * span])
                            if len(inside) >= least and not prefix.isdisjoint(inside):
                                blocks.append({"span": span, "start": a, "ranks": sorted(rank[x] for x in inside)})
                    n, first, last, labels = _phrase_hits(found, wanted)
                    rows.append((len(found), n, first, last, labels, blocks))
                cols = list(zip(*rows, strict=True))
                block = pa.struct([("span", pa.int32()), ("start", pa.int64()), ("ranks", pa.list_(pa.int32()))])
                kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(block)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=out)

    base = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    out = ["id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"]
    found = map_arrow(base, work, f"id {dict(base.dtypes)['id']}, n_words long, n_base long, first_word long, last_word long, "
                                  "base array<string>, blocks array<struct<span int, start long, ranks array<int>>>")
    found = materialise(found.withColumn("uid", F.monotonically_increasing_id()), "license-blocks")

    spark = docs.sparkSession
    index = F.broadcast(spark.createDataFrame(  # a row for each prefix word of each template
        [(k, t.label, t.span, r, sorted(rank[w] for w in t.required), need, i, r[i])
         for k, (t, r, need) in enumerate(ordered) for i in range(len(r) - need + 1)],
        "template int, label string, span int, t_ranks array<int>, required array<int>, need int, i int, rank int"))
    blocks = found.select("uid", F.explode("blocks").alias("at")).select("uid", "at.span", "at.start", "at.ranks")
    probes = blocks.select("uid", "span", "start", "ranks", F.posexplode("ranks").alias("j", "rank"))
    t, b, i, j = F.size("t_ranks"), F.size("ranks"), F.col("i"), F.col("j")
    room = F.least(i, j) + 1 + F.least(t - i - 1, b - j - 1)
    pairs = (probes.join(index, ["span", "rank"]).where((b >= F.col("need")) & (j < b - F.col("need") + 1) & (room >= F.col("need")))
             .select("uid", "span", "start", "template", "label", "need", "ranks", "t_ranks", "required")
             .dropDuplicates(["uid", "span", "start", "template"]))
    overlap = F.size(F.array_intersect("ranks", "t_ranks"))
    hits = (pairs.withColumn("overlap", overlap).where((F.col("overlap") >= F.col("need")) & (F.size(F.array_except("required", "ranks")) == 0))
            .groupBy("uid").agg(F.collect_set("label").alias("matched"), F.max(F.col("overlap") / F.size("t_ranks")).alias("best"),
                                F.countDistinct("span", "start").alias("n_blocks")))
    joined = found.drop("blocks").join(hits, "uid", "left")
    text_of = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", text_of(F.col("base")).alias("base_labels"),
        text_of(F.concat("base", F.coalesce("matched", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_template_blocks"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same rows in SQL, by comparing every block with every template of its span."""
    plain = lambda s: [w.decode() for w in sorted(s)]
    rows = ", ".join(f"('{t.label}', {t.span}, {plain(t.words)}, {plain(t.required)}::VARCHAR[])" for t in template_sets(TEMPLATES, NAMES))
    spots = ", ".join(f"({len(words(p.encode()))}, '{' '.join(x.decode() for x in words(p.encode()))}', '{label}')" for p, label in PHRASES.items())
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return re.sub(r"\n +", "\n", f"""
    WITH t(label, span, ws, required) AS (VALUES {rows}), p(n, phrase, label) AS (VALUES {spots}),
    d AS (SELECT row_number() OVER () AS u, doc_id, {lower} AS x, regexp_extract_all({lower}, {word}) AS w FROM documents),
    spot AS (SELECT u, i, label FROM (SELECT u, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN p ON array_to_string(w[i:i + n - 1], ' ') = phrase),
    b AS (SELECT u, count(*) AS n, min(i) - 1 AS lo, max(i) - 1 AS hi, list(DISTINCT label) AS base FROM spot GROUP BY u),
    s AS (SELECT DISTINCT span FROM t),
    l AS (SELECT u, span, a, list_distinct(w[a + 1:a + 2 * span]) AS ws FROM (
          SELECT u, span, w, unnest(range(0, greatest(len(w) - span, 1), span)) AS a FROM d, s WHERE len(w) > 0)),
    m AS (SELECT u, l.span, a, label, len(list_intersect(l.ws, t.ws)) AS o, len(t.ws) AS n FROM l JOIN t USING (span)
          WHERE len(list_intersect(l.ws, t.ws)) >= {THRESHOLD} * len(t.ws) - 1e-9 AND list_has_all(l.ws, t.required)),
    h AS (SELECT u, list(DISTINCT label) AS found, max(o / n) AS best, count(DISTINCT (span, a)) AS blocks FROM m GROUP BY u)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
      array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ',') AS labels,
      CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score, coalesce(h.blocks, 0)::BIGINT AS n_template_blocks
    FROM d LEFT JOIN b USING (u) LEFT JOIN h USING (u)""")


OP1_SQL = _sql()
