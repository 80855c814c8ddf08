"""SentencePiece encoding with seeded merge-dropout, and decoding (operator 6).

Merges are taken from an agenda, best score first and leftmost among equals, as
the vocabulary's own encoder takes them; but each candidate is skipped with
probability ``dropout`` by a hash keyed with the seed, the segment, its
occurrence (the text it stands in and its place there) and the candidate's
place.  The same seed always gives the same pieces; another seed, or another
occurrence of a repeated segment, gives others.  What is kept of a segment is
only what no skip changes: its pieces and merges where nothing is skipped.  An
occurrence that skips one of these merges runs an agenda of its own.  Whatever is
skipped, the pieces spell the text, so decoding is lossless; characters outside
the vocabulary, and the blank mark itself, go as bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from outflow.llm.bytewords import mix64, powers

MODEL = "piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
#: Occurrences are keyed by a hash modulo this: all of its 64 bits.
VARIANTS = 1 << 64
KEPT_SEGMENTS = 300_000
BLANK = "▁"
_MASK = (1 << 64) - 1


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_KEY = 0x9FB21C651E98DF25
_NEVER = (1 << 31) - 1
_SLOTS = 1 << 20


def _slot(pair: np.ndarray) -> np.ndarray:
    return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def _skipped(key: int, left: int, end: int, skip: int) -> bool:
    """Whether the keyed hash of a candidate's place says to skip it; ``skip`` is out of 2**24."""
    return ((key ^ (left * 0x9E3779B97F4A7C15 + end * 0xC2B2AE3D27D4EB4F)) * 0xD6E8FEB86659FD93 & _MASK) >> 40 < skip


class _Numbers(dict):
    """Numbers of segments in order of their first sight."""

    def __missing__(self, part: str) -> int:
        self[part] = n = len(self)
        return n


def _ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All of first..first+length of every row, one row after the other."""
    return np.arange(int(length.sum())) + np.repeat(first - (np.cumsum(length) - length), length)


class Pieces:
    """One vocabulary: pieces, scores, and what is kept of segments."""

    # No piece crosses from text to a following blank, nor takes a line break.
    SEGMENTS = regex.compile("[\n\t\r]| +[^ \n\t\r]*|[^ \n\t\r]+")

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, kept: int = KEPT_SEGMENTS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.spelled.append(b"")
            else:
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError("a piece holds a blank after text")
                self.score[piece], self.cost[piece] = i, -model.get_score(i)
                self.spelled.append(piece.replace(BLANK, " ").encode("utf-8"))
        self.skip = int(dropout * (1 << 24))
        self.seed, self.kept, self.variants = seed, kept, variants
        self.letter = {(" " if p == BLANK else p): i for p, i in self.score.items() if len(p) == 1}
        self.letter_ids = np.full(max(map(ord, self.letter)) + 2, -1, np.int64)
        for c, i in self.letter.items():
            self.letter_ids[ord(c)] = i
        self._index_pairs(model.get_piece_size())
        self._forget()

    def _forget(self) -> None:
        self.number, self.parts = _Numbers(), []
        none = np.zeros(0, np.int64)
        self.ids, self.id_count, self.id_first = np.zeros(0, np.int32), none, none  # pieces where nothing is skipped
        self.merges, self.merge_count, self.merge_first = np.zeros(0, np.uint64), none, none  # and the places of their merges
        self.sums, self.odd = np.zeros(0, np.uint64), np.zeros(0, bool)

    def _learn(self) -> None:
        """Keep what no skip changes of the segments numbered since the last call."""
        parts = list(self.number)[len(self.parts) :] if len(self.number) > len(self.parts) else []
        if not parts:
            return
        trail: list = []
        found = self.segments(parts, 0, trail)
        _, length, ids, first, plain = self._letters(parts)
        places = np.arange(len(ids)) - np.repeat(first, length)
        weighed = (ids + 1).astype(np.uint64) * powers(int(length.max()), _KEY)[places]
        row = np.concatenate([r for r, _ in trail] or [np.zeros(0, np.int64)])
        order = np.argsort(row, kind="stable")
        merges = np.concatenate([c for _, c in trail] or [np.zeros(0, np.uint64)])[order]
        for name, data, count in (("id", b"".join(found), np.fromiter(map(len, found), np.int64, len(found)) // 4), ("merge", merges.tobytes(), np.bincount(row, minlength=len(parts)))):
            pool = "ids" if name == "id" else "merges"
            begin = len(getattr(self, pool)) + np.cumsum(count) - count
            setattr(self, pool, np.concatenate([getattr(self, pool), np.frombuffer(data, getattr(self, pool).dtype)]))
            setattr(self, f"{name}_count", np.concatenate([getattr(self, f"{name}_count"), count]))
            setattr(self, f"{name}_first", np.concatenate([getattr(self, f"{name}_first"), begin]))
        self.sums = np.concatenate([self.sums, np.add.reduceat(weighed, first)])
        self.odd = np.concatenate([self.odd, ~plain])
        self.parts.extend(parts)

    def _index_pairs(self, size: int) -> None:
        """An open-addressed table from two pieces to the piece they join to."""
        self.piece_cost = np.full(size + 1, _NEVER, np.int32)  # the last is also that of -1
        self.piece_length = np.zeros(size + 1, np.uint64)
        keys, ids = [], []
        for piece, i in self.score.items():
            self.piece_cost[i] = min(int(self.cost[piece]), _NEVER - 1)
            self.piece_length[i] = len(piece)
            for k in range(1, len(piece)):
                left, right = self.score.get(piece[:k]), self.score.get(piece[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(i)
        self.pair_keys = np.full(_SLOTS + 4096, -1, np.int64)
        self.pair_ids = np.full(_SLOTS + 4096, -1, np.int32)
        key, found = np.array(keys, np.int64), np.array(ids, np.int32)
        slot = _slot(key)
        while len(key):  # those that find their slot taken try the next
            free = self.pair_keys[slot] < 0
            first = np.zeros(len(key), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.pair_keys[slot[put]], self.pair_ids[slot[put]] = key[put], found[put]
            key, found, slot = key[~put], found[~put], slot[~put] + ~free[~put]

    def _agenda(self, text: str, variant: int) -> list[int]:
        """Piece ids of marked text (blanks as marks), merge by merge from a heap: any length, any characters."""
        parts: list = list(text)
        cost, skip, n = self.cost, self.skip, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        letters = np.array([[self.letter.get(" " if c == BLANK else c, -1) + 1 for c in text]])
        key = int(self._keys(letters, variant)[0]) if skip else 0
        agenda = [(cost[x + y], k, k + 1, x + y) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in cost]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if parts[left] is None or after[left] != right or len(parts[left]) + len(parts[right]) != len(joined):
                continue
            if skip and _skipped(key, left, left + len(joined), skip):
                continue
            parts[left], parts[right] = joined, None
            follow = after[right]
            after[left] = follow
            if follow >= 0:
                before[follow] = left
                if joined + parts[follow] in cost:
                    heapq.heappush(agenda, (cost[joined + parts[follow]], left, follow, joined + parts[follow]))
            ahead = before[left]
            if ahead >= 0 and parts[ahead] + joined in cost:
                heapq.heappush(agenda, (cost[parts[ahead] + joined], ahead, left, parts[ahead] + joined))
        out: list[int] = []
        for part in parts:
            if part is not None:
                found = self.score.get(part)
                out.extend([self.bytes[b] for b in part.encode("utf-8")] if found is None else [found])
        return out

    def segment(self, text: str, variant: int) -> tuple[int, ...]:
        """Piece ids of one segment (blanks as spaces)."""
        if BLANK not in text:
            return tuple(self._agenda(text.replace(" ", BLANK), variant))
        out: list[int] = []  # the mark itself: bytes only
        for k, piece in enumerate(text.split(BLANK)):
            if k:
                out.extend(self.bytes[b] for b in BLANK.encode("utf-8"))
            if piece:
                out.extend(self._agenda(piece.replace(" ", BLANK), variant))
        return tuple(out)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two neighbours join to, or -1."""
        query = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = _slot(query)
        out = np.where(self.pair_keys[slot] == query, self.pair_ids[slot], -1)
        more = np.flatnonzero((out < 0) & (self.pair_keys[slot] >= 0) & (query >= 0))
        step = 1
        while len(more):
            at = slot[more] + step
            found = self.pair_keys[at]
            hit = found == query[more]
            out[more[hit]] = self.pair_ids[at[hit]]
            more = more[~hit & (found >= 0)]
            step += 1
        return out

    def _letters(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Code points, lengths, letters' ids, first places, and which segments merge in step."""
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids = np.where(points < len(self.letter_ids), self.letter_ids[np.minimum(points, len(self.letter_ids) - 1)], -1)
        first = np.cumsum(length) - length
        plain = (length <= 32) & (np.minimum.reduceat(np.append(ids, 0), first) >= 0) if len(texts) else length > 0
        return points, length, ids, first, plain

    def segments(self, texts: list[str], variant: int | np.ndarray, trail: list | None = None) -> list[bytes]:
        """Piece ids (as 32-bit numbers) of many segments, all merging in step; the same as ``segment`` of each.

        ``variant`` is one number, or one for each segment.  With a ``trail``
        nothing is skipped, the places of the merges are added to it, and odd
        segments, which never merge in step, are left empty if there is dropout.
        """
        out: list = [b""] * len(texts)
        variant = np.broadcast_to(np.asarray(variant, np.uint64), len(texts))
        _, length, ids, first, plain = self._letters(texts)
        for i in np.flatnonzero(~plain).tolist() if trail is None or not self.skip else []:
            out[i] = np.array(self.segment(texts[i], int(variant[i])), "<i4").tobytes()
        low = 0
        for width in (4, 6, 8, 10, 13, 18, 32):
            members = np.flatnonzero(plain & (length > low) & (length <= width))
            low = width
            for at in range(0, len(members), 20_000):
                part = members[at : at + 20_000]
                self._in_step(ids, first[part], length[part], width, variant[part], part, out, trail)
        return out

    def _in_step(self, ids: np.ndarray, first: np.ndarray, length: np.ndarray, width: int, variant: np.ndarray, members: np.ndarray, out: list, trail: list | None) -> None:
        """Each row's best candidate merges or is skipped, round by round; symbols stay at their first letter's place."""
        n, columns = len(members), np.arange(width)
        alive = columns < length[:, None]
        piece = np.full((n, width + 1), -1, np.int64)
        piece[:, :-1][alive] = ids[(first[:, None] + columns)[alive]]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        after[np.arange(n), length - 1] = width  # the column of no piece
        before = np.tile(np.arange(-1, width), (n, 1))
        joined = np.full((n, width + 1), -1, np.int32)
        pairs = columns + 1 < length[:, None]
        joined[:, :-1][pairs] = self._lookup(piece[:, :-1][pairs], piece[:, 1:][pairs])
        cost = self.piece_cost[joined]
        key = self._keys(np.where(alive, piece[:, :-1] + 1, 0), variant) if self.skip and trail is None else None
        rows = np.arange(n)
        while len(rows):
            k = cost[rows].argmin(axis=1)  # leftmost among equals
            live = cost[rows, k] != _NEVER
            rows, k = rows[live], k[live]
            merged = joined[rows, k]
            if self.skip:
                end = k.astype(np.uint64) + self.piece_length[merged]
                place = k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + end * np.uint64(0xC2B2AE3D27D4EB4F)
            if self.skip and trail is not None:
                trail.append((members[rows], place))
            if key is not None:
                skipped = self._skips(key[rows], place)
                cost[rows[skipped], k[skipped]] = _NEVER
                r, k, merged = rows[~skipped], k[~skipped], merged[~skipped]
            else:
                r = rows
            gone = after[r, k]
            piece[r, k] = merged
            alive[r, gone] = False
            cost[r, gone] = _NEVER
            follow = after[r, gone]
            after[r, k] = follow
            before[r, follow] = k
            joined[r, k] = fresh = np.where(follow < width, self._lookup(merged, piece[r, follow]), -1)
            cost[r, k] = self.piece_cost[fresh]
            ahead = before[r, k]
            some = ahead >= 0
            r, ahead, merged = r[some], ahead[some], merged[some]
            joined[r, ahead] = fresh = self._lookup(piece[r, ahead], merged)
            cost[r, ahead] = self.piece_cost[fresh]
        data = piece[:, :-1][alive].astype("<i4").tobytes()
        edges = (np.concatenate([[0], np.cumsum(alive.sum(axis=1))]) * 4).tolist()
        for i, a, z in zip(members.tolist(), edges, edges[1:], strict=False):
            out[i] = data[a:z]

    def _skips(self, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        return (key ^ place) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40) < self.skip

    def _keys(self, letters: np.ndarray, variant: int | np.ndarray) -> np.ndarray:
        """Keys of the skip decisions: of the seed, the variant and the letters' ids plus one (0 past the end)."""
        weights = powers(letters.shape[1], _KEY)
        return self._mixed((letters.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64), variant)

    def _mixed(self, sums: np.ndarray, variant: int | np.ndarray) -> np.ndarray:
        return mix64(sums + (np.atleast_1d(np.asarray(variant, np.uint64)) + np.uint64(self.seed * 64 & _MASK)) * np.uint64(_KEY))

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of whole texts; an empty text has none."""
        cut = [self.SEGMENTS.findall(" " + text) if text else [] for text in texts]
        if len(self.number) > self.kept:
            self._forget()
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        self._learn()
        # An occurrence is told by its text and its place, so copies of a text encode alike.
        whole = np.fromiter((xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) for text in texts), np.uint64, len(texts))
        within = _ragged(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
        variant = mix64(mix64(np.repeat(whole, counts)) + within)
        if self.variants < 1 << 64:
            variant %= np.uint64(self.variants)
        done, sizes = [np.zeros(0, np.int32)], np.zeros(len(number), np.int64)
        for at in range(0, len(number), 200_000):
            part = number[at : at + 200_000]
            ids, sizes[at : at + len(part)] = self._occurrences(part, variant[at : at + len(part)])
            done.append(ids)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return np.split(np.concatenate(done), ends[1:-1]) if texts else []

    def _occurrences(self, number: np.ndarray, variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of segments one after the other, and how many each has."""
        first, count = self.id_first[number], self.id_count[number]
        pool = self.ids
        if self.skip:
            key = self._mixed(self.sums[number], variant)
            merges = self.merge_count[number]
            skipped = self._skips(np.repeat(key, merges), self.merges[_ragged(self.merge_first[number], merges)])
            own = self.odd[number]
            own[np.repeat(np.arange(len(number)), merges)[skipped]] = True
            own = np.flatnonzero(own)
            found = self.segments([self.parts[k] for k in number[own].tolist()], variant[own])
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            first[own], count[own] = len(pool) + np.cumsum(sizes) - sizes, sizes
            pool = np.concatenate([pool, np.frombuffer(b"".join(found), "<i4")])
        return pool[_ragged(first, count)], count

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text that the ids spell, without the blank put before it."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids])[1:].decode("utf-8", "replace")


_PIECES: dict[tuple, Pieces] = {}


def pieces(*args) -> Pieces:
    """The worker's vocabulary, loaded once for each setting."""
    if args not in _PIECES:
        _PIECES[args] = Pieces(*args)
    return _PIECES[args]


def encode(docs: DataFrame, path: str | None = None, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS) -> DataFrame:
    """(doc_id, text, ids): piece ids of every whole text.

    A null text has null ids, an empty one none.  Rows stay as they are, repeated
    ones and null doc_ids too, and nothing is shuffled; an empty table gives no
    rows, texts are encoded whole, however long, and other columns are ignored
    whatever their names.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path, dropout, seed, variants)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                found = p.encode_many([x or "" for x in texts])
                ids = [None if x is None else i for x, i in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded``: the text spelled by ``ids``, null where they are."""
    path = path or model_path()
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [None if x is None else p.decode(x) for x in batch.column("ids").to_pylist()]
                yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_chars, n_tokens, ids, lossless) of every row; a null text counts as empty."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path, DROPOUT, SEED, VARIANTS)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                ids = p.encode_many(texts)
                same = [p.decode(i.tolist()) == x for i, x in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())], names=["doc_id", "n_chars", "ids", "lossless"])

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    done = cut.mapInArrow(run, "doc_id long, n_chars long, ids array<int>, lossless boolean")
    return done.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encoded_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path(MODEL))
