"""Fill-in-the-middle forms of documents by rotating the blocks of a text in place.

A text is cut into prefix, middle and suffix. Each block gets its sentinel in front of it in one bytearray, and the
blocks change places by rotations, each of which is three reversals: ``psm`` exchanges middle and suffix, ``spm``
exchanges what precedes the suffix with the suffix. Restoring finds the sentinels, runs the same rotation the other way
round and deletes the sentinels, so nothing beside the output and its form is needed.

Cuts and forms come from a hash of the id and the seed alone, so reruns and recomputed tasks agree. Every row is handled
by itself in its own task: no shuffle, and one text at a time in memory.

Rules: texts are cut between code points; a null text is an empty one; an empty text, one that holds a sentinel, and
those left out by ``share`` stay as they are (form ``plain``, no cuts); a null id counts as an empty id; rows that repeat
an id have the same hash and are each cut by their own length; an empty table gives an empty result; columns that are not
asked for by ``keep`` are not looked at, and one that has a name of the result is given once, as the result's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ADDED = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of an id."""
    digest = hashlib.sha256(b"%d:%s" % (seed, b"" if doc_id is None else b"%d" % doc_id)).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def characters(data: bytes) -> np.ndarray:
    """Offsets of the first bytes of the code points."""
    return np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


def rotate(block: bytearray, first: int, cut: int, stop: int) -> None:
    """Exchange ``block[first:cut]`` and ``block[cut:stop]`` in place by three reversals."""
    view = np.frombuffer(block, np.uint8)
    for a, b in ((first, cut), (cut, stop), (first, stop)):
        half = (b - a) // 2
        low, high = view[a:a + half], view[b - half:b][::-1]
        held = low.copy()
        low[:] = high
        high[:] = held


def arranged(data: bytes, first: int, second: int, form: str) -> bytearray:
    """The text cut at two byte offsets, with sentinels, in the order of its form."""
    block = bytearray(data)
    block[second:second] = SUFFIX
    block[first:first] = MIDDLE
    block[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    if form == "psm":
        rotate(block, middle, suffix, len(block))
    else:
        rotate(block, 0, suffix, len(block))
    return block


def restored(data: bytes, form: str) -> bytes:
    """The text of an output: rotations inverted, sentinels deleted."""
    if form == "plain":
        return data
    block = bytearray(data)
    if form == "psm":  # prefix, suffix, middle
        suffix, middle = block.index(SUFFIX), block.index(MIDDLE)
        rotate(block, suffix, middle, len(block))
    else:  # suffix, prefix, middle
        rotate(block, 0, block.index(PREFIX), len(block))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = block.index(mark)
        del block[at:at + len(mark)]
    return bytes(block)


def transformed(doc_id: int | None, data: bytes, seed: int, share: int, spm: int) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    at = characters(data)
    n = len(at)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= share:
        return n, "plain", None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < spm else "psm"
    low, high = (int(at[i]) if i < n else len(data) for i in (first, second))
    return n, form, first, second - first, bytes(arranged(data, low, high, form))


def transform(documents: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1, share: int = 90, spm: int = 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, the columns ``keep``, and n, form, prefix_chars, middle_chars, output (UTF-8) of every row.

    ``share`` of 100 texts are cut, ``spm`` of 100 cut ones put their suffix first.
    """
    added = [c.split()[0] for c in ADDED.split(", ")]
    kept = [c for c in keep if c not in (id, *added)]
    source = documents.select(F.col(id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"), *kept)

    def run(batches):
        for batch in batches:
            rows = [transformed(i, t, seed, share, spm) for i, t in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist())]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            new = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *(batch.column(c) for c in kept), *new], names=[id, *kept, *added])

    schema = ", ".join([f"`{id}` bigint", *(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept), ADDED])
    return source.mapInArrow(run, schema)


def restore(frame: DataFrame, text: str = "restored") -> DataFrame:
    """The frame of ``transform`` with the exact text (UTF-8) rebuilt from ``output`` and ``form`` alone."""
    names = [c for c in frame.columns if c != text]

    def run(batches):
        for batch in batches:
            new = [restored(o, f) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.binary())], names=[*names, text])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(names).schema), f"`{text}` binary"])
    return frame.select(names).mapInArrow(run, schema)


def digest(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    both = restore(transform(documents, **options))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def oracle(seed: int = 1, share: int = 90, spm: int = 20) -> str:
    """The same rows in DuckDB SQL."""
    number = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
    h1, h2, h3, h4 = (number.format(i) for i in (1, 9, 17, 25))
    return f"""
    WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    cut AS (SELECT doc_id, t, n, least({h1} % (n + 1), {h2} % (n + 1)) AS a, greatest({h1} % (n + 1), {h2} % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h3} % 100 >= {share} THEN 'plain' WHEN {h4} % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM hashed),
    parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM parts
    """
