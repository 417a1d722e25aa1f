"""BPE encoding by backtracking over Aho-Corasick longest matches, and decoding by
an offset table.

The vocabulary has byte-level symbols and an end-of-word form of each.  A word is
encoded from left to right: take the longest token at the position (Aho-Corasick);
if the pair with the token before it could not stand side by side after all merges,
try the token's next shorter prefix, or step back.  The compatibility of a pair is
found by splitting tokens along their merges and kept in a table.  For a given
vocabulary this gives the same ids as applying merges by rank, in linear time.

Pieces between white space are encoded once per task and remembered (a bounded
table).  Decoding joins tokens with blanks, as a tokenizer without a decoder does,
by one gather over a byte table with offsets.

Defined cases: NULL is the empty text, with no tokens; special token strings in a
text become their ids; equal rows get equal results; texts of any length are whole.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pricebars.llm.words import extended

DEFAULT_VOCABULARY = "word_bpe_49k.json"
MEMORY_PIECES = 100_000
LONG_PIECE = 64
MEMORY_PAIRS = 1_000_000
BATCH_IDS = 1 << 16
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Tokens as strings over 512 symbols: ``b`` is a byte, ``256 + b`` the same
    byte at the end of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        byte_of = {s: b for b, s in enumerate(byte_symbols())}

        def symbols(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix) and token != self.suffix
            raw = [byte_of[c] for c in (token[:-len(self.suffix)] if ends else token)]
            return "".join(map(chr, raw[:-1])) + chr(raw[-1] + 256 * ends)

        self.ids = {symbols(t): i for t, i in model["vocab"].items() if t != self.suffix}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = model["vocab"][a], model["vocab"][b]
            made = model["vocab"][a + b]
            self.rank[left, right] = rank
            self.split.setdefault(made, (left, right))
        self.size = max(names) + 1
        texts = [names.get(i, "").encode() + b" " for i in range(self.size)]
        self.offsets = np.zeros(self.size + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = Memory(self.encode_word)
        self.pieces = Memory(self.encode_piece)
        self._build()

    def forget(self) -> None:
        """Gives back what was remembered of a task's texts."""
        self.words.clear()
        self.pieces.clear()
        self.pairs.clear()

    def _build(self) -> None:
        self.length = {i: len(s) for s, i in self.ids.items()}
        self.longest = ahocorasick.Automaton()
        self.shorter: dict[int, int] = {}
        self._standing: dict[int, bool] = {}
        made = {s: i for s, i in self.ids.items() if self._stands(i)}
        for s, i in made.items():
            self.longest.add_word(s, i)
        self.longest.make_automaton()
        for s, i in made.items():
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in made:
                    self.shorter[i] = made[s[:n]]
                    break

    def _stands(self, token: int) -> bool:
        """Whether merging the token's own text gives the token: both parts do, and
        no merge across their border comes before their own."""
        known = self._standing.get(token)
        if known is None:
            if token in self.split:
                left, right = self.split[token]
                known = self._stands(left) and self._stands(right) and self._compatible(left, right, self._made_at(token))
            else:
                known = self.length.get(token) == 1
            self._standing[token] = known
        return known

    def _made_at(self, token: int) -> int:
        """Rank of the merge that makes the token; -1 for a single symbol."""
        return self.rank[self.split[token]] if token in self.split else -1

    def _compatible(self, left: int, right: int, limit: int) -> bool:
        """No merge across the border of the two tokens comes before ``limit``.
        Merges are undone from the latest on, so each border pair that once stood
        there is compared with the merge that took one side away.  Of two merges of
        one rank the left one was first, so the right one is undone first."""
        while True:
            if self.rank.get((left, right), limit) < limit:
                return False
            made_left, made_right = self._made_at(left), self._made_at(right)
            if made_left > made_right:
                limit, left = made_left, self.split[left][1]
            elif made_right >= 0:
                limit, right = made_right + 1, self.split[right][0]
            else:
                return True

    def encode_word(self, word: str) -> bytes:
        raw = word.encode()
        text = "".join(map(chr, raw[:-1])) + chr(raw[-1] + (256 if self.suffix else 0))
        # the longest token at a position; every symbol is a token
        longest, length, shorter, pairs = self.longest.iter_long, self.length, self.shorter, self.pairs
        end, at = len(text), 0
        out: list[int] = []
        dead: set[int] = set()  # positions from which the rest can't be encoded
        token = next(longest(text, 0))[1]
        while at < end:
            stop = at + length[token]
            fits = stop not in dead
            if fits and out:
                pair = (out[-1], token)
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= MEMORY_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self._compatible(*pair, 1 << 59)
            if fits:
                out.append(token)
                at = stop
                if at < end:
                    token = next(longest(text, at))[1]
            elif token in shorter:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
        return struct.pack(f"<{len(out)}I", *out)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece without white space, as little-endian 32-bit integers."""
        found = self.pattern.findall(piece)
        return self.words[found[0]] if len(found) == 1 else b"".join(map(self.words.__getitem__, found))

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the decoded texts and the offset of each; text ``i`` has the ids
        from ``first[i]`` on."""
        start, length = self.offsets[ids], np.diff(self.offsets)[ids]
        ahead = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=ahead[1:])
        at = np.arange(ahead[-1]) + np.repeat(start - ahead[:-1], length)
        return self.bytes[at], ahead[first]


class Memory(dict):
    """What ``encode`` gave for each string of up to ``LONG_PIECE`` characters, longer ones are not
    remembered; starts anew at ``MEMORY_PIECES``."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        out = self.encode(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= MEMORY_PIECES:
                self.clear()
            self[piece] = out
        return out


_LOADED: dict[str, Vocabulary] = {}


def loaded(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode_text(text: str, vocabulary: Vocabulary) -> bytes:
    if vocabulary.special and "<|" in text:
        parts = regex.split("(" + "|".join(map(regex.escape, vocabulary.special)) + ")", text)
        if len(parts) > 1:
            return b"".join(np.array([vocabulary.special[p]], "<u4").tobytes() if p in vocabulary.special else encode_text(p, vocabulary) for p in parts)
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    pieces = regex.split(SPACE, text) if regex.search("[\x1c-\x1f]", text) else text.split()
    return b"".join(map(vocabulary.pieces.__getitem__, pieces))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of ints) and ``decoded`` (the text of the ids)."""
    docs = docs.drop("ids", "decoded")
    fields, out = docs.schema.names, extended(docs.schema, ids="array<long>", decoded="string")

    def run(batches):
        vocabulary = loaded(path)
        for batch in batches:
            for a, b, ids, first in _encoded(batch.column(fields.index(text)), vocabulary):
                data, offsets = vocabulary.decode(ids, first)
                told = [data[s:max(s, e - 1)].tobytes().decode() for s, e in zip(offsets[:-1], offsets[1:])]
                part = batch.slice(a, b - a)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(told, pa.string())], names=[*part.schema.names, "ids", "decoded"])
        vocabulary.forget()

    return docs.mapInArrow(run, out)


def _encoded(column: pa.Array, vocabulary: Vocabulary):
    """Runs of rows ``(first, end, ids, first id of each row)`` of bounded size."""
    row, parts = 0, []
    held = 0
    for k in range(len(column)):
        parts.append(encode_text(column[k].as_py() or "", vocabulary))
        held += len(parts[-1])
        if held >= 4 * BATCH_IDS or k == len(column) - 1:
            first = np.zeros(len(parts) + 1, np.int64)
            np.cumsum([len(p) // 4 for p in parts], out=first[1:])
            yield row, k + 1, np.frombuffer(b"".join(parts), "<u4"), first
            row, parts, held = k + 1, [], 0


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with token count and digests of ids and decoded text."""
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")
    fields = docs.schema.names
    kept = [i for i, name in enumerate(fields) if name != text]
    out = extended(docs.drop(text).schema, n_tokens="long", ids_sha256="string", decoded_sha256="string")

    def run(batches):
        vocabulary = loaded(path)
        for batch in batches:
            for a, b, ids, first in _encoded(batch.column(fields.index(text)), vocabulary):
                raw = memoryview(np.ascontiguousarray(ids).view(np.uint8))
                data, offsets = vocabulary.decode(ids, first)
                data = memoryview(data)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), pa.array(np.diff(first)),
                     pa.array([hashlib.sha256(raw[4 * s:4 * e]).hexdigest() for s, e in zip(first[:-1], first[1:])], pa.string()),
                     pa.array([hashlib.sha256(data[s:max(s, e - 1)]).hexdigest() for s, e in zip(offsets[:-1], offsets[1:])], pa.string())],
                    names=out.names)
        vocabulary.forget()

    return docs.mapInArrow(run, out)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, vocabulary_path())


def tokens(docs: DataFrame) -> DataFrame:
    """Pipeline stage: token count and digests of every document."""
    return digests(docs.select("doc_id", "text"), vocabulary_path())
