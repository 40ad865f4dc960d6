"""Operator 13: byte-level BPE encoding and decoding.

The pattern cuts a text into words. The bytes of a word, read as Latin-1, go through one Aho-Corasick automaton of all tokens, which gives the longest token at
every place. From the left the longest token is taken if merging could leave it beside the token before, else the next shorter one; where none fits, the token before
gives way to its own next shorter one, and the place is marked so that it is never tried again. Whether two tokens can stand side by side is decided from their merge
trees alone and kept in a bounded memory. A word takes one step per byte and length of token, and the result is exactly that of merging the
lowest rank first, with the leftmost first among equals.

Decoding joins the bytes of the ids' tokens. Null and empty texts have no ids. Rows are independent, so repeated rows and ties need no rule. A text may be one word of any
length; words above 64 characters are not remembered, and what is remembered is bounded in characters, not in words.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .common import besides, documents, schema_of, sha256, to_table, with_text

#: Characters of remembered words per worker, and pairs of tokens.
MEMORY, PAIRS = 6_000_000, 500_000
LONG = 64
_NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _ranges(chars: str) -> str:
    """A set of characters as ranges for a bracket expression."""
    at = np.sort(np.frombuffer(chars.encode("utf-32-le"), np.uint32))
    cut = np.flatnonzero(np.diff(at) != 1)
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]))


CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def with_classes(pattern: str, classes: dict[str, str]) -> re.Pattern:
    """``pattern`` with ranges in place of the names of character classes."""
    out = []
    for part in re.split(r"(\[[^\]]*\])", pattern):
        for name, chars in classes.items():
            part = part.replace(name, chars if part[:1] == "[" else f"[{chars}]")
        out.append(part.replace(r"\S", f"[^{classes[CLASSES[2]]}]"))
    return re.compile("".join(out))


class Splitter:
    """Cuts texts into words by a pattern whose classes are those of the tiktoken library's Unicode tables, which need not be the tables of Python's libraries.

    The fast forms are exact where they are used: ranges for ASCII texts, and the regex library for texts without a character that it classes otherwise.
    """

    def __init__(self, pattern: str) -> None:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {bytes([b]): b for b in range(256)}
        classes, short, disputed = {}, {}, set()
        for name in CLASSES:
            inside = bytes(tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
            classes[name] = _ranges(inside)
            short[name] = _ranges("".join(c for c in inside if c.isascii()))
            disputed.update(set(inside) ^ set(regex.findall(name, every)))
        self.ascii, self.exact, self.any = with_classes(pattern, short), with_classes(pattern, classes), regex.compile(pattern)
        self.odd = re.compile(f"[{_ranges(''.join(disputed))}]") if disputed else re.compile("(?!)")

    def findall(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        return (self.exact if self.odd.search(text) else self.any).findall(text)


class BytePairs:
    """Encodes and decodes by one table of ranks (bytes to id; a token's id is the rank of its merge)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY, pairs: int = PAIRS) -> None:
        self.ranks = ranks
        self.find = Splitter(pattern).findall
        self.parts = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.parts[i] = token
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks need every single byte")
        self._grow_trees()
        self.memory, self.pairs = memory, pairs
        self.words: dict[str, bytes] = {}
        self.room = memory
        self.known: dict[int, bool] = {}

    def merged(self, word: bytes, below: int = _NEVER) -> list[bytes]:
        """The parts left by merging pairs of rank under ``below``, lowest rank first: the definition, used for tokens only."""
        rank_of = self.ranks.get
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks = [rank_of(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
        while ranks:
            least = min(ranks)
            if least >= below:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], _NEVER)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], _NEVER)
        return parts

    def _grow_trees(self) -> None:
        """Each token's last merge; from them, its edges: the tokens that lie at its left or right end while it is merged, with the rank that takes each up."""
        self.joins: dict[int, int] = {}  # left id << 32 | right id: the rank of both together
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.shorter: dict[int, int] = {}  # the longest token that starts a token and is shorter than it
        automaton = ahocorasick.Automaton()
        for token, i in sorted(self.ranks.items(), key=lambda x: x[1]):
            halves = [(self.ranks[token[:k]], self.ranks[token[k:]]) for k in range(1, len(token)) if token[:k] in self.ranks and token[k:] in self.ranks]
            for a, b in halves:
                self.joins[a << 32 | b] = i
            self.left[i], self.right[i] = [(i, _NEVER)], [(i, _NEVER)]
            if len(token) > 1:
                parts = self.merged(token, i)
                if len(parts) != 2:
                    continue  # no merge makes this token; only a word equal to it has it
                a, b = (self.ranks[p] for p in parts)
                self.left[i] += [(t, min(until, i)) for t, until in self.left[a]]
                self.right[i] += [(t, min(until, i)) for t, until in self.right[b]]
            automaton.add_word(token.decode("latin-1"), (len(token), i))
        automaton.make_automaton()
        self.tokens = automaton
        for token, i in self.ranks.items():
            for k in range(len(token) - 1, 0, -1):
                if token[:k].decode("latin-1") in automaton:
                    self.shorter[i] = self.ranks[token[:k]]
                    break

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` side by side: no two of their edge tokens that are ever neighbours join before one of them is taken up."""
        joins, i, j = self.joins, 0, 0
        left, right = self.right[a], self.left[b]  # from the whole token down to a single byte
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = joins.get(x << 32 | y)
            # a join of the same rank as the merge inside ``a`` comes later, being further right; inside ``b`` it comes first
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            # undo the later of the two merges
            more_x, more_y = i + 1 < len(left), j + 1 < len(right)
            if more_x and (not more_y or x > y):
                i += 1
            elif more_y:
                j += 1
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word by longest tokens and backtracking."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        longest = [0] * n
        for end, (size, i) in self.tokens.iter(word.decode("latin-1")):
            longest[end - size + 1] = i  # later ends are longer
        parts, shorter, known, fits = self.parts, self.shorter, self.known, self.fits
        if len(known) > self.pairs:
            known.clear()
        out: list[int] = []
        dead = bytearray(n + 1)  # places from which no encoding goes on
        at, token = 0, longest[0]
        while True:
            end = at + len(parts[token])
            ok = not dead[end]
            if ok and out:
                key = out[-1] << 32 | token
                ok = known.get(key)
                if ok is None:
                    ok = known[key] = fits(out[-1], token)
            if ok:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
                continue
            follow = shorter.get(token)
            while follow is None:  # nothing fits here: the token before gives way
                dead[at] = 1
                token = out.pop()
                at -= len(parts[token])
                follow = shorter.get(token)
            token = follow

    def learn(self, words: Iterable[str]) -> None:
        """Encode words not yet known, as little-endian numbers."""
        new = set(words).difference(self.words)
        size = sum(map(len, new))
        if size > self.room:
            self.words.clear()
            self.room = self.memory
        for w in new:
            if len(w) <= LONG and self.room > 0:
                self.words[w] = np.array(self.encode_word(w.encode()), "<u4").tobytes()
                self.room -= len(w)

    def encode(self, text: str | None) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit numbers."""
        words = self.find(text) if text else []
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        self.learn(words)
        known = self.words
        return b"".join([known[w] if w in known else np.array(self.encode_word(w.encode()), "<u4").tobytes() for w in words])

    def decode(self, ids: bytes) -> bytes:
        parts = self.parts
        return b"".join([parts[i] for i in np.frombuffer(ids, "<u4").tolist()])


_codecs: dict[tuple[str, str], BytePairs] = {}


def codec(path: str, pattern: str) -> BytePairs:
    """One codec per worker process, rank file and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = BytePairs(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode_texts(docs: DataFrame, keep: list[str], ranks_path: str, pattern: str, *, text_col: str = "text", ids: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256 of every row, and on request the ids themselves.

    ``ranks_path``: a file of ranks that every executor has. Null and empty texts have no tokens. A kept column with
    the name of a result's gives way to it.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    keep = besides(keep, schema)
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in batch.column(place):
                found = c.encode(text.as_py())
                out["n_tokens"].append(len(found) // 4)
                out["ids_sha256"].append(sha256(found))
                out["decoded_sha256"].append(sha256(c.decode(found)))
                if ids:
                    out["ids"].append(np.frombuffer(found, "<u4").astype(np.int32))
            new = to_table(out, schema)
            cols = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, *[new.column(n).combine_chunks() for n in new.schema.names]], names=[*keep, *new.schema.names])

    return rows.mapInArrow(run, schema_of(docs.select(*keep), schema))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    path, pattern = default_ranks()
    return encode_texts(documents(spark, sf_dir), ["doc_id"], path, pattern)


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
