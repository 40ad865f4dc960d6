"""Operator 10: SentencePiece encoding and decoding for merge-type vocabularies.

A text starts as a row of characters. An agenda holds every pair of neighbours whose join is a piece, best score first and leftmost first among
equals; the best pair is joined and its new neighbours enter the agenda, until it is empty. Characters without a piece become their UTF-8 bytes.
No piece of such a vocabulary holds a space mark after another character, so a text falls into independent chunks at its spaces (and at line
ends, where no piece has one), and the ids of a chunk are kept in a bounded memory. In every Arrow batch the sentencepiece library encodes and decodes all chunks
that are new and some texts as a whole, and decodes the ids of every text; the task fails at the first difference.

Null and empty texts have no ids. Rows are independent, so repeated rows and ties need no rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import documents, schema_of, sha256, to_table, with_text

SPACE = "▁"
#: Chunks a worker keeps, with so many characters each on average at most; longer ones are encoded whenever they occur.
MEMORY, MEAN, LONG = 450_000, 16, 200
#: The rank of a pair that has no join.
NEVER = np.iinfo(np.int32).max


class PieceCodec:
    """Encodes by the agenda and decodes, for one model file of merge type with byte fallback."""

    def __init__(self, path: str, memory: int = MEMORY) -> None:
        self.memory = memory
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        ids = range(lib.get_piece_size())
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.ranks = {lib.id_to_piece(i): -lib.get_score(i) for i in plain}
        self.byte_ids = {int(lib.id_to_piece(i)[3:5], 16): i for i in ids if lib.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary needs byte fallback")
        inner = {c for piece in self.ids if len(piece) > 1 for c in piece}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece holds a space mark after another character")
        self.stop = stop = "" if "\n" in inner else "\n"
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + ("|\n" if stop else ""))
        self.parts = [bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else lib.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        self.prefix = SPACE if lib.encode("a", out_type=str)[0].startswith(SPACE) else ""  # some models put a space before every text
        self._number_pairs()
        self.names = [str(i) for i in ids]
        self.ints = list(ids)  # one object for each id
        self.numbers: dict[str, str] = {}  # of known chunks: the ids as text
        self.lists: dict[str, tuple[int, ...]] = {}  # and as they are
        self.odd: dict[str, str] = {}  # and what they decode to, where that is not the chunk itself with plain spaces
        self.size = 0  # characters of the chunks kept
        self.passing: list[str] = []  # long chunks of the texts at hand, forgotten with the next ones

    def _number_pairs(self) -> None:
        """Joins as sorted numbers (left * size + right) with their rank and piece, and the piece of each character."""
        size = len(self.parts)
        joins = []
        for piece, at in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    joins.append((left * size + right, self.ranks[piece], at))
        joins.sort()
        order = {r: i for i, r in enumerate(sorted({r for _, r, _ in joins}))}
        self.join_keys = np.array([k for k, _, _ in joins] + [np.iinfo(np.int64).max], np.int64)
        self.join_ranks = np.array([order[r] for _, r, _ in joins] + [NEVER], np.int32)
        self.join_ids = np.array([i for _, _, i in joins] + [0], np.int32)
        self.char_ids = np.full(0x110000, -1, np.int32)
        for piece, at in self.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = at

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * len(self.parts) + right)
        at = np.searchsorted(self.join_keys, key)
        hit = self.join_keys[at] == key
        return np.where(hit, self.join_ranks[at], NEVER), self.join_ids[at]

    def merge_rows(self, ids: np.ndarray) -> list[list[int]]:
        """The agenda of many chunks at once: row by row the pieces of the characters, padded with -1; each step joins every row's best pair."""
        n, width = ids.shape
        out: list[list[int]] = [[] for _ in range(n)]
        rows = np.arange(n)
        place = np.arange(width)
        rank, join = self._ranks_of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if not rank.shape[1]:  # one piece each
                for r, row in zip(rows.tolist(), ids.tolist()):
                    out[r] = row
                break
            best = np.argmin(rank, axis=1)
            each = np.arange(len(rows))
            done = rank[each, best] == NEVER
            if done.any():
                for r, row in zip(rows[done].tolist(), ids[done].tolist()):
                    out[r] = row[: row.index(-1)] if row[-1] < 0 else row
                live = ~done
                rows, ids, rank, join, best = rows[live], ids[live], rank[live], join[live], best[live]
                each = np.arange(len(rows))
            if not len(rows):
                break
            ids[each, best] = join[each, best]
            # close the gap: every row gives up the right one of its pair and the pair, so all are one place shorter
            n, width = len(rows), ids.shape[1]
            ids = ids[place[:width] != best[:, None] + 1].reshape(n, width - 1)
            others = place[: width - 1] != best[:, None]
            rank, join = rank[others].reshape(n, width - 2), join[others].reshape(n, width - 2)
            for at in (best - 1, best):  # the joined piece with its new neighbours
                ok = (at >= 0) & (at < width - 2)
                e, a = each[ok], at[ok]
                rank[e, a], join[e, a] = self._ranks_of(ids[e, a], ids[e, a + 1])
        return out

    def merge_all(self, chunks: list[str], long: int = 48) -> list[list[int]]:
        """Ids of many chunks; short ones of known characters side by side, the others one by one."""
        out: list[list[int] | None] = [None] * len(chunks)
        order = sorted((i for i, c in enumerate(chunks) if 1 < len(c) <= long), key=lambda i: len(chunks[i]))
        for a in range(0, len(order), 8192):
            part = order[a : a + 8192]
            width = len(chunks[part[-1]])
            flat = np.frombuffer("".join([chunks[i].ljust(width, "\0") for i in part]).encode("utf-32-le"), np.uint32).reshape(len(part), width)
            ids = self.char_ids[flat]
            inside = place_in(width, [len(chunks[i]) for i in part])
            plain = ((ids >= 0) | ~inside).all(1)
            ids[~inside] = -1
            for i, got in zip([i for i, p in zip(part, plain.tolist()) if p], self.merge_rows(ids[plain])):
                out[i] = got
        return [self.merge(c) if got is None else got for c, got in zip(chunks, out)]

    def merge(self, text: str) -> list[int]:
        """Ids of one chunk by the agenda."""
        symbols: list[str | None] = list(text)
        n, ranks = len(symbols), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            piece = text[i : i + 2]
            rank = ranks.get(piece)
            if rank is not None:
                agenda.append((rank, i, piece))
        heapify(agenda)
        while agenda:
            _, i, piece = heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or len(symbols[i]) + len(symbols[j]) != len(piece):
                continue  # one of the two has been joined meanwhile
            symbols[i], symbols[j] = piece, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(piece + symbols[k])
                if rank is not None:
                    heappush(agenda, (rank, i, piece + symbols[k]))
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbols[h] + piece)
                if rank is not None:
                    heappush(agenda, (rank, h, symbols[h] + piece))
        out, ids, byte_ids = [], self.ids, self.byte_ids
        for s in symbols:
            if s is not None:
                at = ids.get(s)
                if at is not None:
                    out.append(at)
                else:
                    out.extend(byte_ids[b] for b in s.encode())
        return out

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks not yet known by the agenda and decode them again; both are checked against the library, all chunks in one call."""
        for c in self.passing:
            self.numbers.pop(c, None)
            self.lists.pop(c, None)
            self.odd.pop(c, None)
        self.passing = []
        new = chunks.difference(self.numbers)
        if not new:
            return
        size = sum(len(c) for c in new if len(c) <= LONG)
        if len(self.numbers) + len(new) > self.memory or self.size + size > MEAN * self.memory:
            self.numbers.clear()
            self.lists.clear()
            self.odd.clear()
            self.size = 0
            new = chunks
            size = sum(len(c) for c in new if len(c) <= LONG)
        self.size += size
        self.passing = [c for c in new if len(c) > LONG]
        new = list(new)
        found = self.merge_all(new)
        read = [b"".join([self.parts[i] for i in ids]).decode("utf-8", "replace") for ids in found]
        if self.stop:  # a line end keeps the chunk apart from the space put before every text
            lead = self.library.encode(self.stop)
            end = self.library.encode(2 * self.stop)[len(lead) :]
            for a in range(0, len(new), 256):  # many chunks a call, each after a line end
                ids = lead[: -len(end)] + list(chain.from_iterable([end + row for row in found[a : a + 256]]))
                if ids != self.library.encode(self.stop + self.stop.join(new[a : a + 256])):
                    raise ValueError("ids differ from the library's")
                if self.stop + self.stop.join(read[a : a + 256]) != self.library.decode(ids):
                    raise ValueError("decoded text differs from the library's")
        names = self.names
        self.numbers.update(zip(new, [",".join([names[i] for i in ids]) for ids in found]))
        same = self.ints.__getitem__
        self.lists.update((c, tuple(map(same, ids))) for c, ids in zip(new, found))
        self.odd.update((c, r) for c, r in zip(new, read) if r != c.replace(SPACE, " "))

    def split(self, texts: list[str]) -> list[list[str]]:
        """The chunks of each text, all of them learnt."""
        found = [self.chunk.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(found)))
        return found

    def decoded(self, chunks: list[str]) -> str:
        """What the ids of learnt chunks decode to."""
        if self.odd:
            text = "".join([self.odd.get(c) or c.replace(SPACE, " ") for c in chunks])
        else:
            text = "".join(chunks).replace(SPACE, " ")
        return self.without_prefix(text)

    def encode(self, text: str | None) -> list[int]:
        chunks = self.split([text or ""])[0]
        return list(chain.from_iterable([self.lists[c] for c in chunks]))

    def decode(self, ids: list[int]) -> str:
        return self.without_prefix(b"".join([self.parts[i] for i in ids]).decode("utf-8", "replace"))

    def without_prefix(self, text: str) -> str:
        """A decoded text without the space put before it."""
        return text[1:] if self.prefix and text[:1] == " " else text


def place_in(width: int, lengths: list[int]) -> np.ndarray:
    return np.arange(width) < np.array(lengths)[:, None]


_codecs: dict[tuple[str, int], PieceCodec] = {}


def codec(path: str, memory: int = MEMORY) -> PieceCodec:
    """One codec per worker process, model and size of memory."""
    if (path, memory) not in _codecs:
        _codecs[path, memory] = PieceCodec(path, memory)
    return _codecs[path, memory]


def _step(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded number of characters, so that long texts do not pile up ids."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(docs: DataFrame, keep: list[str], model_path: str, *, text_col: str = "text", ids: bool = False, memory: int = MEMORY) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256 of every row, and the ids themselves on request.

    ``memory``: chunks a worker keeps, about 300 bytes each, of ``MEAN`` characters on average at most; chunks above ``LONG`` characters are never kept. Raises in the task if a batch's ids or decoded texts differ from the library's.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path, memory)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for a, b in _step(texts):
                part = [t or "" for t in texts[a:b]]
                coded = c.split(part)
                lists = [",".join(map(c.numbers.__getitem__, row)) for row in coded]
                decoded = [c.decoded(row) for row in coded]
                own = [list(chain.from_iterable(map(c.lists.__getitem__, row))) for row in coded]
                if c.library.decode(own, num_threads=1) != decoded:
                    raise ValueError("the decoding of a text's ids differs from the library's")
                for k in range(1 if c.stop else len(part)):  # texts encoded as they are, beside all of their chunks
                    if own[k] != c.library.encode(part[k]):
                        raise ValueError("a text's ids differ from the library's")
                out = {"n_tokens": [x.count(",") + 1 if row else 0 for x, row in zip(lists, coded)], "ids_sha256": [sha256(x.encode()) for x in lists],
                       "decoded_sha256": [sha256(d.encode()) for d in decoded]}
                if ids:
                    out["ids"] = own
                new = to_table(out, schema)
                cols = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, *[new.column(n).combine_chunks() for n in new.schema.names]], names=[*keep, *new.schema.names])

    return rows.mapInArrow(run, schema_of(docs.select(*keep), schema))


def op10_piece_encoding(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return encode_texts(documents(spark, sf_dir), ["doc_id"], model_path or default_model())


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
