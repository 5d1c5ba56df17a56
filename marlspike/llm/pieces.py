"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is escaped (spaces become the mark U+2581, one is put in front) and cut
wherever two neighbouring characters stand side by side in no piece of the
vocabulary: no merge can cross such a cut, so each distinct stretch between cuts
is encoded on its own, once per batch or less. Within a stretch all adjacent
symbol pairs that form a piece wait on an agenda ordered by score, then position;
the best pair is merged and its neighbours enter, until the agenda is empty. A
character outside the vocabulary is a stretch of its own and becomes byte pieces.
Short stretches are merged many at a time: each is a row of a matrix, its agenda
the row of its pairs' scores, and every step merges the best pair of each row.

Every text's result is checked against the sentencepiece library stretch by
stretch: what a task has not met lately is encoded by both, in one library call
per Arrow batch, and a difference raises an error. Decoding joins the pieces'
bytes, marks as spaces, and drops the space of the first piece.

Texts are handled whole. The memory is bounded by a batch slice, its longest text
and MOST_KEPT stretches. Defined results: a table without rows gives no rows; a null text counts as empty; an empty
text has no ids and decodes to an empty text. A literal U+2581 decodes to a space,
as in the library. Repeated rows give repeated results; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import returning, slices

MARK = "▁"
MOST_KEPT = 250_000  # stretches whose ids a task remembers
SLICE = 1_000_000  # bytes of text that are cut into stretches at once
LONG = 256  # longer stretches are not remembered
WIDTHS = (4, 6, 9, 13, 20, 32)  # longer stretches are merged one by one


def _ranges(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i] + counts[i]] for each i, one after the other."""
    before = np.cumsum(counts) - counts
    return values[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


class Vocabulary:
    """The pieces of a merge-type model and the agenda that applies them."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        special = [
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)
            for i in range(size)
        ]
        self.ids = {n: i for i, n in enumerate(names) if not special[i]}
        self.scores = {n: self.library.get_score(i) for n, i in self.ids.items()}
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(names) if self.library.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary needs byte pieces")
        self.raw = [n.replace(MARK, " ").encode() for n in names]
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        for i in range(size):
            if self.library.is_control(i):
                self.raw[i] = b""
            elif self.library.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
        self.byte_ids = set(self.bytes.values())
        self.decimals = pa.array([str(i) for i in range(size)], pa.large_string())
        self.surfaces = pa.array(self.raw, pa.large_binary())
        self.score = np.array([self.library.get_score(i) for i in range(size)])
        pairs = {}
        for name, number in self.ids.items():
            for cut in range(1, len(name)):
                left, right = self.ids.get(name[:cut]), self.ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number
        self.pairs = np.array(sorted(pairs), np.int64)
        self.whole = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        letters = sorted({c for n in self.ids for c in n if c in self.ids})
        self.letter = np.full(0x110000, -1, np.int32)  # the piece of a character
        self.rank = np.zeros(0x110000, np.int32)  # 0: in no piece
        for place, c in enumerate(letters):
            self.letter[ord(c)] = self.ids[c]
            self.rank[ord(c)] = place + 1
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for name in self.ids:
            place = [int(self.rank[ord(c)]) for c in name]
            for one, two in zip(place, place[1:]):
                if one and two:
                    self.beside[one, two] = True
        self.forget()

    def forget(self) -> None:
        """Remember no stretch."""
        self.kept: dict[str, int] = {}  # stretch: its place in the arrays below
        self.kept_ids, self.kept_ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merge(self, stretch: str) -> tuple:
        """The ids of one escaped stretch."""
        symbols: list[str | None] = list(stretch)
        scores = self.scores
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda = []
        for left in range(len(symbols) - 1):
            whole = symbols[left] + symbols[left + 1]
            if whole in scores:
                agenda.append((-scores[whole], left, left + 1, whole))
        heapq.heapify(agenda)
        end = len(symbols)
        while agenda:
            _, left, right, whole = heapq.heappop(agenda)
            one, two = symbols[left], symbols[right]
            if one is None or two is None or after[left] != right or one + two != whole:
                continue
            symbols[left], symbols[right] = whole, None
            following = after[left] = after[right]
            if following < end:
                before[following] = left
                wider = whole + symbols[following]
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], left, following, wider))
            previous = before[left]
            if previous >= 0:
                wider = symbols[previous] + whole
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], previous, left, wider))
        found: list[int] = []
        for symbol in symbols:
            if symbol is not None:
                number = self.ids.get(symbol)
                if number is None:
                    found += [self.bytes[b] for b in symbol.encode()]
                else:
                    found.append(number)
        return tuple(found)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece of each pair or -1, its score or -inf)."""
        key = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        piece = np.where(self.pairs[place] == key, self.whole[place], -1)
        return piece, np.where(piece >= 0, self.score[piece], -np.inf)

    def merge_rows(self, stretches: list[str], width: int) -> np.ndarray:
        """merge() of stretches of up to `width` characters that are all pieces
        themselves: a row of ids for each, -1 where it has none."""
        count = len(stretches)
        padded = "".join([x.ljust(width, "\0") for x in stretches])
        code = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(count, width)
        size = np.array([len(x) for x in stretches])
        inside = np.arange(width) < size[:, None]
        symbols = np.where(inside, self.letter[code], -1).astype(np.int64)
        piece, score = self._pair(symbols[:, :-1], symbols[:, 1:])
        done = np.full((count, width), -1, np.int64)
        alive = np.arange(count)
        columns = np.arange(width)
        while len(alive):
            best = score.argmax(axis=1)
            rows = np.arange(len(alive))
            going = score[rows, best] > -np.inf
            done[alive[~going], : symbols.shape[1]] = symbols[~going]
            alive, best = alive[going], best[going]
            symbols, piece, score = symbols[going], piece[going], score[going]
            if not len(alive):
                break
            rows = np.arange(len(alive))
            merged = piece[rows, best]
            wide = symbols.shape[1]
            keep = columns[:wide] != best[:, None] + 1  # the right one of the pair goes
            symbols = symbols[keep].reshape(len(alive), wide - 1)
            symbols[rows, best] = merged
            keep = columns[: wide - 1] != best[:, None]
            piece = piece[keep].reshape(len(alive), wide - 2)
            score = score[keep].reshape(len(alive), wide - 2)
            for at in (best - 1, best):
                there = np.flatnonzero((at >= 0) & (at < wide - 2))
                spot = at[there]
                piece[there, spot], score[there, spot] = self._pair(
                    symbols[there, spot], symbols[there, spot + 1]
                )
            if wide - 2 == 0:
                done[alive, 0] = symbols[:, 0]
                break
        return done

    def merge_all(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): merge() of each stretch, one after the other."""
        sizes = np.array([len(x) for x in stretches], np.int64)
        joined = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        known = np.minimum.reduceat(self.letter[joined], np.cumsum(sizes) - sizes) >= 0
        order, values, counts = [], [], []
        low = 1
        for width in WIDTHS:
            chosen = np.flatnonzero(known & (sizes >= low) & (sizes <= width))
            if len(chosen):
                rows = self.merge_rows([stretches[i] for i in chosen.tolist()], width)
                real = rows >= 0
                order.append(chosen)
                values.append(rows[real])
                counts.append(real.sum(axis=1))
            low = width + 1
        alone = np.flatnonzero(~known | (sizes >= low))
        if len(alone):
            found = [self.merge(stretches[i]) for i in alone.tolist()]
            order.append(alone)
            values.append(np.array(list(chain.from_iterable(found)), np.int64))
            counts.append(np.array([len(x) for x in found]))
        order, counts = np.concatenate(order), np.concatenate(counts)
        values = np.concatenate(values)
        starts = np.cumsum(counts) - counts
        back = np.argsort(order)
        return _ranges(values, starts[back], counts[back]).astype(np.int32), np.cumsum(counts[back])

    def look_up(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of distinct stretches; those not remembered are encoded and
        compared with the library."""
        kept = self.kept
        place = np.array([kept.get(x, -1) for x in stretches], np.int64)
        missing = np.flatnonzero(place < 0)
        starts, counts = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        had = place >= 0
        starts[had] = self.kept_ends[place[had]]
        counts[had] = self.kept_ends[place[had] + 1] - starts[had]
        pool = self.kept_ids
        if len(missing):
            new = [stretches[i] for i in missing.tolist()]
            ids, ends = self.merge_all(new)
            self.compare(new, ids, ends)
            sizes = np.diff(ends, prepend=0)
            starts[missing], counts[missing] = len(pool) + ends - sizes, sizes
            pool = np.concatenate([pool, ids])
            if len(kept) + len(new) > MOST_KEPT:
                self.forget()
                kept = self.kept
            short = np.flatnonzero([len(x) <= LONG for x in new])[: MOST_KEPT - len(kept)]
            kept.update(zip([new[i] for i in short.tolist()], range(len(kept), len(kept) + len(short))))
            added = _ranges(ids, (ends - sizes)[short], sizes[short])
            self.kept_ends = np.concatenate([self.kept_ends, len(self.kept_ids) + np.cumsum(sizes[short])])
            self.kept_ids = np.concatenate([self.kept_ids, added])
        return _ranges(pool, starts, counts), np.cumsum(counts)

    def compare(self, stretches: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Raise an error where the library encodes a stretch in another way.

        The library puts a mark in front of every text. Behind a newline, which is
        in no piece, a stretch stands as it would in the middle of a text."""
        lead = self.library.encode("\n")
        theirs = self.library.encode(["\n" + x.replace(MARK, " ") for x in stretches], num_threads=1)
        flat = np.fromiter(chain.from_iterable(theirs), np.int32)
        sizes = np.fromiter(map(len, theirs), np.int64, len(theirs))
        starts = np.cumsum(sizes) - sizes
        mine = np.diff(ends, prepend=0)
        right = sizes == mine + len(lead)
        if right.all():
            rest = _ranges(flat, starts + len(lead), mine)
            if np.array_equal(rest, ids):
                return
        for stretch, ours, other in zip(stretches, np.split(ids, ends[:-1]), theirs):
            if ours.tolist() != other[len(lead) :]:
                raise ValueError(f"differs from the library: {stretch[:200]!r}")

    def flat_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i]:offsets[i + 1]]."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        empty = pa.scalar("", pa.large_string())
        escaped = pc.utf8_replace_slice(pc.replace_substring(texts, " ", MARK), 0, 0, MARK)
        escaped = pc.if_else(pc.equal(texts, empty), empty, escaped)
        sizes = pc.utf8_length(escaped).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        if edges[-1] == 0:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        data = pc.binary_join(
            pa.LargeListArray.from_arrays(pa.array([0, len(escaped)], pa.int64()), escaped), empty
        )[0].as_buffer()
        code = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
        rank = self.rank[code]
        cut = np.ones(len(code), bool)
        cut[1:] = ~self.beside[rank[:-1], rank[1:]]
        cut[edges[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        width = np.ones(len(code), np.uint8)
        for limit in (0x80, 0x800, 0x10000):
            width += code >= limit
        places = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        offsets = np.append(places[starts], places[-1])
        stretches = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), data)
        coded = stretches.dictionary_encode()
        ids, ends = self.look_up(coded.dictionary.to_pylist())
        counts = np.diff(ends, prepend=0)
        codes = coded.indices.to_numpy()
        sizes = counts[codes]
        running = np.concatenate([[0], np.cumsum(sizes)])
        return (
            _ranges(ids, (ends - counts)[codes], sizes),
            running[np.searchsorted(starts, edges)],
        )

    def encode_all(self, texts: pa.Array) -> pa.Array:
        ids, offsets = self.flat_ids(texts)
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text]))[0].as_py()

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
        """(number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text) of
        each text; the decoded text is that of decode()."""
        ids, offsets = self.flat_ids(texts)
        found = []
        for table, joint, skip in ((self.decimals, ",", 0), (self.surfaces, b"", 1)):
            lists = pa.LargeListArray.from_arrays(pa.array(offsets), table.take(pa.array(ids)))
            joined = pc.binary_join(lists, pa.scalar(joint, table.type)).cast(pa.large_binary())
            _, ends, data = joined.buffers()
            ends = np.frombuffer(ends, np.int64)[: len(texts) + 1].tolist()
            view = memoryview(data if data is not None else b"")
            # an encoded text always starts with a mark, decoding drops its space
            found.append([hashlib.sha256(view[min(a + skip, b) : b]).hexdigest() for a, b in zip(ends, ends[1:])])
        return np.diff(offsets), *found

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.raw[i] for i in ids])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        first = next((i for i in ids if not self.library.is_control(i)), None)
        marked = first is not None and first not in self.byte_ids and not self.library.is_unknown(first)
        return text[1:] if marked and self.raw[first][:1] == b" " else text

    def _decode_broken(self, ids: list[int]) -> str:
        """Ids whose byte pieces are no UTF-8: each byte that fits no character
        becomes U+FFFD."""
        out, run = [], bytearray()

        def flush():
            data = bytes(run)
            while data:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(data[:size].decode())
                        data = data[size:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    data = data[1:]
            run.clear()

        for i in ids:
            if i in self.byte_ids:
                run.append(self.raw[i][0])
            else:
                flush()
                out.append(self.raw[i].decode())
        flush()
        return "".join(out)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def model_path(path: str | None = None) -> str:
    """The given path, or that of the public vocabulary installed on each machine."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def in_task(run, path: str | None):
    """run, a function of a task's batches, with nothing remembered behind it."""
    return returning(run, lambda: vocabulary(model_path(path)).forget())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc, ids) for each row of docs."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))

    def run(batches):
        words = vocabulary(model_path(path))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = words.encode_all(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(ids, pa.list_(pa.int32()))], ["doc", "ids"]
                )

    return rows.mapInArrow(in_task(run, path), f"doc {rows.schema['doc'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc, text) for rows (doc, ids); null ids decode to a null text."""
    rows = encoded.select("doc", "ids")

    def run(batches):
        words = vocabulary(model_path(path))
        for batch in batches:
            texts = [None if x is None else words.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    return rows.mapInArrow(in_task(run, path), f"doc {rows.schema['doc'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc, n_tokens, ids_sha256, decoded_sha256): encode, decode, and sum up both,
    in one pass, so that neither ids nor texts travel between processes."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))

    def run(batches):
        words = vocabulary(model_path(path))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, ids, texts = words.sums(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(sizes), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                    ["doc", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(in_task(run, path), f"doc {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs).withColumnRenamed("doc", "doc_id")


QUERIES = {"op2_sentencepiece": (op2_sentencepiece, None)}
