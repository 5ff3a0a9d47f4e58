"""Removal of passages that repeat anywhere in a corpus.

Runs of ``span`` words are the edges of a De Bruijn graph. A document is a walk over edges; the edges that share
their smallest inner word group (the anchor) follow each other, so a walk falls into short paths, one per anchor.
Paths are compacted through joins: equal paths are one path with a count, and where an anchor has one path only, none
of its edges branches, so the count of the path is the count of each edge. Only where paths of an anchor differ are
their edges counted one by one, for one document of each path. Source coordinates (document, first word, edges) lead
back to the spans, which are cut out of the whole text.

Equal edges have equal anchors at equal places, so no repeat is lost; edges are told apart by 128 bits from two families
of word hashes that have nothing in common, paths by the anchor and 64 bits of the second family. Rules: words are split at ASCII white space and compared unchanged; a null text has no words;
a text shorter than ``span`` keeps everything; repeated rows are repeats of each other; empty table, empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import INVERSE, by_rows, hashed, powers, saved, scramble, sha, signed, windows, words_of

SPAN = 35
#: Words of an anchor.
ANCHOR = 6

PATHS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("anchor", pa.int64()), ("path", pa.int64()), ("start", pa.int32()), ("edges", pa.int32())])
EDGES = pa.schema([("anchor", pa.int64()), ("path", pa.int64()), ("copies", pa.int64()), ("edge", pa.int32()), ("e1", pa.int64()), ("e2", pa.int64())])


def smallest(order: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value among each ``width`` neighbours, by doubling."""
    at = np.arange(len(order))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(order[right] < order[left], right, left)
        have += step
    return at


def paths(hashes: np.ndarray, ends: np.ndarray, others: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """text (its place), anchor, path, start, edges of all paths in some texts whose word hashes (of two families) stand in a row."""
    begin = np.concatenate([[0], ends[:-1]])
    text = np.repeat(np.arange(len(ends)), ends - begin)
    edges = len(hashes) - span + 1
    if edges <= 0:
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    grams = windows(hashes, ANCHOR)
    at = smallest(scramble(grams, 5), span - ANCHOR + 1)
    inside = text[:edges] == text[span - 1:]
    new = np.concatenate([[True], at[1:] != at[:-1]])
    # A path starts at an edge inside one text whose anchor differs from that of the edge before.
    start = np.flatnonzero(inside & (new | ~np.concatenate([[False], inside[:-1]])))
    stop = np.flatnonzero(inside & (np.concatenate([new[1:], [True]]) | ~np.concatenate([inside[1:], [False]]))) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scramble(others, 9) * powers(len(others)), dtype=np.uint64)])
    # The sum from a to b is a multiple of the factor's a-th power, so its inverse makes it free of the place.
    path = scramble((sums[stop + span - 1] - sums[start]) * powers(len(hashes), INVERSE)[start] + (stop - start).astype(np.uint64), 3)
    return text[start], grams[at[start]], path, start - begin[text[start]], stop - start


def pieces(texts: list[str | None], most: int = 1 << 20):
    """Runs of texts of about ``most`` characters, as (first, stop)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def walks(documents: DataFrame, span: int) -> DataFrame:
    """The paths of every document, with their coordinates."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, stop in pieces(texts):
                text, anchor, path, start, edges = paths(*hashed(texts[first:stop]), hashed(texts[first:stop], family=1)[0], span)
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(signed(anchor)), pa.array(signed(path)),
                                                  pa.array(start.astype(np.int32)), pa.array(edges.astype(np.int32))], schema=PATHS)

    return documents.mapInArrow(run, "doc_id bigint, text_hash bigint, anchor bigint, path bigint, start int, edges int")


def edges_of(chosen: DataFrame, span: int) -> DataFrame:
    """The edges of chosen paths: rows with text and a list ``paths`` of (anchor, path, copies, start, edges).

    Other columns are taken along unread: the texts then come from the very shuffle that the last join reads.
    """

    def run(batches):
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), batch.column("paths")
            for first, stop in pieces(texts):
                both = [hashed(texts[first:stop], family=f) for f in (0, 1)]
                ends = both[0][1]
                found = lists.slice(first, stop - first)
                begin = np.repeat(np.concatenate([[0], ends[:-1]]), np.diff(found.offsets.to_numpy()))
                path = found.flatten()
                n = path.field("edges").to_numpy()
                at = np.repeat(path.field("start").to_numpy() + begin, n)
                edge = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                col = [pa.array(np.repeat(path.field(c).to_numpy(), n)) for c in ("anchor", "path", "copies")]
                yield pa.RecordBatch.from_arrays([*col, pa.array(edge.astype(np.int32)), *(pa.array(signed(windows(h, span, seed)[at + edge])) for (h, _), seed in zip(both, (0, 11)))], schema=EDGES)

    return chosen.mapInArrow(run, "anchor bigint, path bigint, copies bigint, edge int, e1 bigint, e2 bigint")


def repeated(documents: DataFrame, span: int = SPAN, *keep) -> DataFrame:
    """doc_id, text, spans and ``row`` (the columns ``keep``): each document with the (first edge, edges) that repeat.

    Rows that share id and text have the same spans, which a set holds once.
    """
    row = [F.struct(*keep).alias("row")] if keep else []
    full = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text", *row)
    docs = full.select("doc_id", "text_hash", "text")
    walked = walks(docs, span)
    # Written, so that the join below reads both sides from plain shuffles and a hot anchor can be split.
    anchors = saved(walked.groupBy("anchor").agg(F.count(F.lit(1)).alias("uses"), F.min("path").alias("low"), F.max("path").alias("high"))
               .where("uses > 1").select("anchor", (F.col("low") != F.col("high")).alias("branches")))
    shared = saved(walked.join(anchors, "anchor"))
    compact = shared.groupBy("anchor", "path").agg(F.count(F.lit(1)).alias("copies"), F.first("branches").alias("branches"), F.min(F.struct("doc_id", "text_hash", "start", "edges")).alias("at"))
    chosen = (compact.where("branches").groupBy(F.col("at.doc_id").alias("_id"), F.col("at.text_hash").alias("_hash"))
              .agg(F.collect_list(F.struct("anchor", "path", "copies", "at.start", "at.edges")).alias("paths")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    edges = edges_of(full.join(chosen, same), span)
    # A repeated row gives its edges twice; a path counts once, with its copies.
    often = edges.groupBy("e1", "e2").agg(F.sum("copies").alias("uses"), F.min(F.struct("anchor", "path", "edge")).alias("a"), F.max(F.struct("anchor", "path", "edge")).alias("b"))
    often = often.where("a != b or uses > 1").select("e1", "e2")
    marked = edges.join(often, ["e1", "e2"]).groupBy("anchor", "path").agg(F.collect_set("edge").alias("list"))
    whole = compact.where("copies > 1").select("anchor", "path", F.lit(None).cast("array<int>").alias("list"))
    known = marked.join(whole.select("anchor", "path"), ["anchor", "path"], "left_anti").unionByName(whole)
    spans = (shared.join(known, ["anchor", "path"])
             .select("doc_id", "text_hash", F.explode(F.expr("case when list is null then array(struct(start, edges)) else transform(list, i -> struct(start + i as start, 1 as edges)) end")).alias("span"))
             .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("span").alias("spans")))
    return full.join(spans, same, "left").select("doc_id", "text", "spans", *(["row"] if keep else []))


def cut(text: str | None, spans: list | None, span: int) -> tuple[list[bytes], int]:
    """The words that stay and the number of those that go."""
    words = words_of(text)
    if not spans:
        return words, 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["start"] + s["edges"] + span - 1 for s in spans], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())


def digest(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def row(doc_id, text, spans):
        kept, gone = cut(text, spans, span)
        return doc_id, len(kept) + gone, gone, sha(b" ".join(kept))

    return repeated(documents, span).mapInArrow(by_rows(row, schema, "doc_id", "text", "spans"), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents with what is left of each text, its words joined by one space; others stay as they are.

    ``n_chars``, where there is such a column, follows the text.
    """

    def run(batches):
        for batch in batches:
            new = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                kept, gone = cut(text, spans, span)
                new.append(b" ".join(kept).decode("utf-8", "surrogatepass") if gone else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(new, pa.string()), batch.column("row")], names=["doc_id", "text", "row"])

    others = [c for c in documents.columns if c not in ("doc_id", "text", "n_chars")]
    keep = others or [F.lit(0).alias("none")]
    source = repeated(documents, span, *keep)
    out = source.mapInArrow(run, f"doc_id bigint, text string, row {source.schema['row'].dataType.simpleString()}")
    known = {"doc_id": F.col("doc_id").cast(documents.schema["doc_id"].dataType), "text": F.col("text")}
    if "n_chars" in documents.columns:
        known["n_chars"] = F.length("text").cast(documents.schema["n_chars"].dataType)
    return out.select(*(known[c].alias(c) if c in known else F.col("row")[c].alias(c) for c in documents.columns))


def oracle(span: int = SPAN) -> str:
    """The same rows in DuckDB SQL."""
    return f"""
    WITH words AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    runs AS (SELECT row, unnest(range(1, len(w) - {span} + 2)) AS s, w FROM words WHERE len(w) >= {span}),
    keyed AS (SELECT row, s, md5(array_to_string(w[s:s + {span - 1}], ' ')) AS h FROM runs),
    twice AS (SELECT row, s FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM keyed) WHERE n > 1),
    gone AS (SELECT DISTINCT row, unnest(range(s, s + {span})) AS p FROM twice),
    each AS (SELECT row, doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM words),
    kept AS (SELECT e.row, count(*) AS n_words, count(g.p) AS n_removed, coalesce(string_agg(CASE WHEN g.p IS NULL THEN e.word END, ' ' ORDER BY e.p), '') AS t
             FROM each e LEFT JOIN gone g ON e.row = g.row AND e.p = g.p GROUP BY e.row)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM words LEFT JOIN kept USING (row)
    """
