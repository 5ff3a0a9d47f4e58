"""Byte-pair encoding by longest matches with backtracking, and decoding by an offset table.

The encoder never replays merges. At each position it takes the longest token that an Aho-Corasick automaton finds,
keeps it if the pair with the token before it is compatible (no merge across their border would have come first), and
otherwise falls back to the next shorter token. The kept sequence is the one that merging in rank order gives.

Rules: a null or empty text has no tokens and decodes to an empty text; repeated rows are encoded each by itself.
The vocabulary file is read on the executors from the path given, which every machine has with the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillframe.llm.common import by_rows, sha

#: Fixed values of the file format: Unicode white space and the pattern that cuts normalised text into words.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
SEPARATORS = re.compile(r"[\x1c-\x1f]")
BLANKS = regex.compile(rf"[{SPACE}]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where it prints, else one past 255 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairTable(dict):
    """Which pairs of neighbouring tokens are compatible, filled as pairs turn up and emptied when it is full."""

    most = 1_000_000

    def __init__(self, rule):
        super().__init__()
        self.rule = rule

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= self.most:
            self.clear()
        value = self[pair] = self.rule(*pair)
        return value


class Vocabulary:
    """The tables of one tokenizer file: automaton, merges, splits, next shorter tokens and offsets."""

    def __init__(self, path: str, most_words: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        # Inside the tables the word end is one sign of its own, outside the byte letters.
        self.mark = "\ue000"
        inner = {i: (t[:-len(self.end)] + self.mark if self.end and t.endswith(self.end) and len(t) > len(self.end) else t) for t, i in self.vocab.items()}
        self.length = {i: len(t) for i, t in inner.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            ids, made = (self.vocab[a], self.vocab[b]), self.vocab[a + b]
            self.merge[ids] = (rank, made)
            if made not in self.split:
                self.split[made], self.rank[made] = ids, rank
        self.automaton = ahocorasick.Automaton()
        by_text = {t: i for i, t in inner.items()}
        for t, i in by_text.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        # A token can only end a longest match if merging its own text gives it back.
        self.shorter = {i: next((by_text[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_text), -1) for i, t in inner.items()}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.pairs = PairTable(self.compatible)
        self.most_words = most_words
        self.cut_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max(self.names) + 1
        texts = [(self.names.get(i, "") + " ").encode() for i in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """True if merging keeps the border between the two tokens: no merge over it comes before their own."""
        limit = 1 << 60
        while True:
            found = self.merge.get((left, right))
            if found and found[0] < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.split[left][1]
            else:
                # A merge of the same rank further left comes first, so one over the border may only tie from the left.
                limit, right = b + 1, self.split[right][0]

    def encode_word(self, word: str) -> tuple[int, ...]:
        text = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) + self.mark
        n = len(text)
        longest, length, shorter, pairs = [-1] * n, self.length, self.shorter, self.pairs
        for stop, token in self.automaton.iter(text):
            longest[stop - length[token] + 1] = token  # stops only grow, so the last one is the longest
        tokens: list[int] = []
        dead = bytearray(n + 1)  # positions from which no rest of the word can be encoded
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                stop = at + length[token]
                if not dead[stop] and (stop == n or longest[stop] >= 0) and (not tokens or pairs[tokens[-1], token]):
                    break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                if at == n:
                    return tuple(tokens)
                token = longest[at]
            else:
                dead[at] = 1
                if not tokens:
                    return ()
                token = tokens.pop()
                at -= length[token]
                token = shorter[token]

    def word(self, word: str) -> bytes:
        """Ids of one word, as the little-endian numbers that a text's ids are joined from."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.most_words:
                self.words.clear()
            ids = array("I", self.encode_word(word)).tobytes()
            if len(word) <= 64:
                self.words[word] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids of a run without white space. Lower case goes letter by letter: a final sigma is no special case."""
        plain = unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3").lower()
        ids = b"".join(map(self.word, CUT.findall(plain)))
        if len(self.chunks) >= self.most_words:
            self.chunks.clear()
        if len(chunk) <= 64:
            self.chunks[chunk] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Neither composition nor a word reaches over white space, so each run between white space stands alone."""
        out: list[bytes] = []
        known, slow = self.chunks.get, self.chunk
        for part in self.cut_special.split(text or "") if self.cut_special else [text or ""]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                # str.split() also splits at four control characters that are no white space here
                out.extend([known(c) or slow(c) for c in (BLANKS.split(part) if SEPARATORS.search(part) else part.split())])
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The names of the tokens, a space between two, gathered from one table by offsets."""
        if not len(ids):
            return b""
        out = []
        for i in range(0, len(ids), 1 << 20):  # in pieces, so that the index array stays small
            part = ids[i:i + (1 << 20)].astype(np.int64)
            size = self.offsets[part + 1] - self.offsets[part]
            shift = self.offsets[part] - (np.cumsum(size) - size)
            out.append(self.blob[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)[:-1]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One set of tables for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and token ids of each text."""
    fn = by_rows(lambda i, text: (i, vocabulary(path).encode(text)), ENCODED, "doc_id", "text")
    return documents.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(fn, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of each list of ids; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    fn = by_rows(lambda i, ids: (i, vocabulary(path).decode(np.array(ids or [], np.int64)).decode()), schema, "doc_id", "ids")
    return encoded.mapInArrow(fn, "doc_id bigint, text string")


def corpus(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256: the encoded corpus with the digests that check it."""
    schema = pa.schema([DIGEST.field("doc_id"), DIGEST.field("n_tokens"), ENCODED.field("ids"), DIGEST.field("ids_sha256"), DIGEST.field("decoded_sha256")])

    def row(doc_id, text):
        tables = vocabulary(path)
        ids = tables.encode(text)
        return doc_id, len(ids), ids.astype(np.int32), sha(ids.tobytes()), sha(tables.decode(ids))

    out = "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return documents.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(by_rows(row, schema, "doc_id", "text"), out)


def digest(documents: DataFrame, path: str) -> DataFrame:
    """Per document: n_tokens, and the digests of its ids and of what they decode to, in one pass over the texts."""

    def row(doc_id, text):
        tables = vocabulary(path)
        ids = tables.encode(text)
        return doc_id, len(ids), sha(ids.tobytes()), sha(tables.decode(ids))

    return documents.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(by_rows(row, DIGEST, "doc_id", "text"), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
