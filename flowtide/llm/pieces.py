"""SentencePiece encoding and decoding by a streaming Viterbi search over the pieces.

Of a model of scored pieces (unigram) the search finds the best sum of scores. A model of merges
(BPE) defines its result by the order of merges instead: a segmentation is its result exactly if
merging leaves each two neighbouring pieces as they are, so only such steps are allowed, and each
boundary then has one path to it. Either way the search keeps a window bounded by the longest piece. Whenever all surviving backpointer paths
meet in one boundary, the ids before it are final and the window moves up. Two kinds of boundaries
are known beforehand: if no piece has a blank after another character, all paths meet before every
run of blanks, and they meet around each character that no longer piece contains. The text is cut
there. Cuts that fit in one window are searched together in numpy, all of a batch's new ones a boundary at a
time, and remembered, as most words repeat; longer ones are searched one by one with the window moving on.

The text is read as it is (no normalisation), after one blank unless it is empty. Blanks are the
pieces' U+2581; a character without a piece, U+2581 itself included, becomes the pieces of its UTF-8
bytes, so decoding gives back every text exactly. Of equal sums the segmentation with the longer
last piece wins.

Null text has null ids and null ids decode to null; an empty text has no ids. Unknown and control
ids decode to nothing, bytes that are no UTF-8 to U+FFFD. Extra columns are carried along; one named
like an output is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm.common import utf8_parts

MODEL_BYTES = 64 << 20
#: A window has room for four of the longest pieces.
REMEMBERED, WINDOWS = 200_000, 4
PART_BYTES, ROWS = 1 << 20, 500
_CHARS = 1 << 21


class Codec:
    """Pieces of a model file and the search over them."""

    def __init__(self, content: bytes, merges: bool = True) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i).replace("▁", " "): (model.get_score(i), i) for i in plain}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in self.byte_id):
            raise ValueError("the model has no pieces for single bytes")
        self.text = {i: piece for piece, (_, i) in self.score.items()}
        # Score and id of each piece; no score for what only begins one.
        self.known = {piece[:n]: (None, -1) for piece in self.score for n in range(1, len(piece) + 1)} | self.score
        self.merges, self.pairs = merges, {}
        self.longest = max(map(len, self.score), default=1)
        self.unknown = min((s for s, _ in self.score.values()), default=0.0) - 10
        self.content = [b""] * len(ids)
        for piece, (_, i) in self.score.items():
            self.content[i] = piece.encode()
        for b, i in enumerate(self.byte_id):
            self.content[i] = bytes([b])
        longer = set("".join(p for p in self.score if len(p) > 1))
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in longer)
        alone_or = f"[{alone}]|" if alone else ""
        blank_first = not any(" " in p.lstrip(" ") for p in self.score)
        self.cut = re.compile(f"{alone_or} *[^ {alone}]+| +" if blank_first else r"[\s\S]+").findall
        self.remembered: dict[str, bytes] = {}
        self._build_tables()

    def _build_tables(self) -> None:
        """The pieces' prefixes as nodes of a trie, edges sorted by node and character; bytes of all pieces in one array."""
        nodes = {"": 0} | {prefix: n for n, prefix in enumerate(self.known, 1)}
        edges = sorted((nodes[p[:-1]] * _CHARS + ord(p[-1]), n) for p, n in nodes.items() if p)
        self.edge_key = np.array([k for k, _ in edges], np.int64)
        self.edge_node = np.array([n for _, n in edges], np.int64)
        self.node_piece = np.full(len(nodes), -1, np.int64)
        self.node_score = np.zeros(len(nodes))
        for piece, (score, i) in self.score.items():
            self.node_piece[nodes[piece]], self.node_score[nodes[piece]] = i, score
        self.pair_key, self.pair_stays = np.zeros(1, np.int64), np.zeros(1, bool)
        self.piece_bytes = np.frombuffer(b"".join(self.content), np.uint8)
        self.piece_size = np.array([len(c) for c in self.content], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size

    def search(self, text: str) -> list[int]:
        """Ids of the segmentation that ends the one path through all of ``text``."""
        known, pairs, merges, window, n = self.known, self.pairs, self.merges, self.longest, len(text)
        # best, back and last belong to the boundary after `start + place` characters.
        start, best, back, last, out = 0, [0.0], [0], [-1], []
        for i in range(n):
            here, before = best[i - start], last[i - start]
            if here is not None:
                end = i + 1
                found = known.get(text[i:end])
                if found is None:
                    found = self.unknown, -1
                while found is not None:
                    score, piece = found
                    if score is None and end == i + 1:
                        score = self.unknown
                    if score is not None:
                        at = end - start
                        while len(best) <= at:
                            best.append(None)
                            back.append(0)
                            last.append(-1)
                        if merges:
                            if before >= 0 and piece >= 0 and i > 0:
                                stays = pairs.get(before << 32 | piece)
                                if stays is None:
                                    stays = pairs[before << 32 | piece] = self._stays(before, piece)
                            else:
                                stays = True
                            if stays:
                                best[at], back[at], last[at] = 0.0, i, piece
                        elif best[at] is None or here + score > best[at]:
                            best[at], back[at], last[at] = here + score, i, piece
                    end += 1
                    if end > n:
                        break
                    found = known.get(text[i:end])
            if i + 1 - start >= WINDOWS * window:
                # Paths that can still grow end after this character or up to a piece before and after it.
                ends = {p for p in range(i + 1, start + len(best)) if best[p - start] is not None}
                while len(ends) > 1:
                    furthest = max(ends)
                    ends.remove(furthest)
                    ends.add(back[furthest - start])
                (meet,) = ends
                if meet > start:
                    out += self._ids(text, back, start, meet)
                    cut = meet - start
                    best, back, last, start = best[cut:], back[cut:], last[cut:], meet
        return out + self._ids(text, back, start, n)

    def _pairs_stay(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``_stays`` of many pairs, each different one worked out once."""
        key = first << 32 | second
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        stays, known = self.pair_stays[at], self.pair_key[at] == key
        if not known.all():
            new, which = np.unique(key[~known], return_inverse=True)
            answers = []
            for k in new.tolist():
                stay = self.pairs.get(k)
                if stay is None:
                    stay = self.pairs[k] = self._stays(k >> 32, k & 0xFFFFFFFF)
                answers.append(stay)
            stays[~known] = np.array(answers)[which]
        return stays

    def _sort_pairs(self) -> None:
        if len(self.pairs) + len(self.pair_key) > 4 * REMEMBERED:
            self.pair_key, self.pair_stays = np.zeros(1, np.int64), np.zeros(1, bool)
        key = np.concatenate([self.pair_key, np.fromiter(self.pairs, np.int64, len(self.pairs))])
        stays = np.concatenate([self.pair_stays, np.fromiter(self.pairs.values(), bool, len(self.pairs))])
        self.pair_key, first = np.unique(key, return_index=True)
        self.pair_stays = stays[first]
        self.pairs.clear()

    def search_many(self, texts: list[str]) -> list[bytes]:
        """Ids, as 32-bit numbers, of texts that fit in one window: the search of all at once, boundary by boundary."""
        if not texts:
            return []
        texts_by_size = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
        size = np.array([len(texts[t]) for t in texts_by_size], np.int64)
        chars = np.frombuffer("".join([texts[t] for t in texts_by_size]).encode("utf-32-le"), np.uint32).astype(np.int64)
        char_at = np.cumsum(size) - size
        bound_at = char_at + np.arange(len(texts))
        best = np.full(int(size.sum()) + len(texts), -np.inf)
        back, last = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int64)
        best[bound_at] = 0.0

        def reach(text: np.ndarray, i: int, end: int, piece: np.ndarray, score: np.ndarray) -> None:
            here, there = bound_at[text] + i, bound_at[text] + end
            total = best[here] + (0.0 if self.merges else score)
            if self.merges:
                before = last[here]
                ask = (before >= 0) & (piece >= 0)
                good = np.ones(len(text), bool)
                good[ask] = self._pairs_stay(before[ask], piece[ask])
            else:
                good = total > best[there]
            there = there[good]
            best[there], back[there], last[there] = total[good], i, piece[good]

        for i in range(int(size[0])):
            text = np.arange(np.searchsorted(-size, -i))
            text = text[best[bound_at[text] + i] > -np.inf]
            node, end = np.zeros(len(text), np.int64), i
            while len(text):
                end += 1
                key = node * _CHARS + chars[char_at[text] + end - 1]
                at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
                found = self.edge_key[at] == key
                node = np.where(found, self.edge_node[at], 0)
                piece = np.where(found, self.node_piece[node], -1)
                if end == i + 1:  # a character without a piece goes by its bytes
                    reach(text, i, end, piece, np.where(piece >= 0, self.node_score[node], self.unknown))
                else:
                    whole = piece >= 0
                    reach(text[whole], i, end, piece[whole], self.node_score[node[whole]])
                on = found & (size[text] > end)
                text, node = text[on], node[on]
        self._sort_pairs()
        return self._traced([texts[t] for t in texts_by_size], texts_by_size, size, bound_at, back, last)

    def _traced(self, texts: list[str], place: list[int], size, bound_at, back, last) -> list[bytes]:
        """Follow all backpointers together; ids of each text in the order of ``place``."""
        text, end = np.arange(len(texts)), size
        steps = []
        while len(text):
            piece, start = last[bound_at[text] + end], back[bound_at[text] + end]
            steps.append((text, piece, start))
            text, end = text[start > 0], start[start > 0]
        owner, piece, start = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((start, owner))
        owner, piece, start = owner[order], piece[order], start[order]
        ends = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        ids = piece.astype("<i4").tobytes()
        by_bytes = set(owner[piece < 0].tolist())
        out = [b""] * len(texts)
        for t, (first, stop) in enumerate(zip(ends, ends[1:])):
            if t in by_bytes:
                found: list[int] = []
                for p, at in zip(piece[first:stop].tolist(), start[first:stop].tolist()):
                    found += [p] if p >= 0 else [self.byte_id[x] for x in texts[t][at].encode()]
                out[place[t]] = array("i", found).tobytes()
            else:
                out[place[t]] = ids[4 * first : 4 * stop]
        return out

    def _stays(self, first: int, second: int) -> bool:
        """Whether merging would leave this pair of pieces as it is."""
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        a, b = self.text[first], self.text[second]
        parts = list(a + b)
        while True:
            joined = [(self.score[x + y][0], -i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in self.score]
            if not joined:
                return parts == [a, b]
            i = -max(joined)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _ids(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        cuts = [end]
        while cuts[-1] > start:
            cuts.append(back[cuts[-1] - start])
        out: list[int] = []
        for b, a in zip(cuts[-2::-1], cuts[:0:-1], strict=True):
            found = self.score.get(text[a:b])
            out += [found[1]] if found else [self.byte_id[x] for x in text[a:b].encode()]
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as 32-bit numbers."""
        cuts = [self.cut(" " + text) if text else [] for text in texts]
        remembered = self.remembered
        if len(remembered) > REMEMBERED:
            remembered.clear()
        new = {word for words in cuts for word in words} - remembered.keys()
        window = WINDOWS * self.longest
        short = [word for word in new if len(word) <= window]
        remembered.update(zip(short, self.search_many(short)))
        long = {word: array("i", self.search(word)).tobytes() for word in new if len(word) > window}
        if not long:
            return [b"".join(map(remembered.__getitem__, words)) for words in cuts]
        return [b"".join([remembered[w] if len(w) <= window else long[w] for w in words]) for words in cuts]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def content_of(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of many texts' ids, without each text's blank at the front, and the texts' ends among them."""
        known = (ids >= 0) & (ids < len(self.piece_size))
        ids = np.where(known, ids, 0)
        size = np.where(known, self.piece_size[ids], 0)
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(ends[-1]) + np.repeat(self.piece_start[ids] - ends[:-1], size)
        content, bounds = self.piece_bytes[place], ends[starts]
        filled = bounds[:-1] < bounds[1:]
        blank = np.zeros(len(content), bool)
        blank[bounds[:-1][filled]] = content[bounds[:-1][filled]] == 32
        dropped = np.concatenate([[0], np.cumsum(blank)])
        return content[~blank], bounds - dropped[bounds]

    def decode_many(self, column: pa.ListArray) -> pa.Array:
        """Texts of a column of ids; null for null."""
        ids, starts = column.values.fill_null(-1).to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        ids, starts = ids[starts[0] : starts[-1]], starts - starts[0]
        content, bounds = self.content_of(ids, starts)
        whole = content.tobytes()
        inner = bounds[bounds < len(content)]
        try:
            whole.decode()
            sound = not ((content[inner] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            sound = False
        if sound:
            texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(whole)).cast(pa.string())
        else:
            texts = pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.string())
        missing = column.is_null()
        return pc.if_else(missing, pa.scalar(None, pa.string()), texts) if column.null_count else texts

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


def load(spark: SparkSession, path: str) -> Broadcast:
    """A model file, read by Spark and sent to all executors once; it has at most ``MODEL_BYTES``."""
    row = spark.read.format("binaryFile").load(path).filter(F.col("length") <= MODEL_BYTES).select("content").first()
    if row is None:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast(bytes(row["content"]))


@cache
def _codec(content: bytes, merges: bool) -> Codec:
    return Codec(content, merges)


def encode(
    docs: DataFrame, model: Broadcast, text: str = "text", ids: str = "ids", merges: bool = True, decoded: str | None = None
) -> DataFrame:
    """All columns with the array ``ids``. ``merges`` says that the model is one of merges.

    ``decoded`` names a further column with the text that ``decode`` makes of the ids, in the same pass.
    """
    docs = docs.select(*[c for c in docs.columns if c not in (ids, decoded)])
    place = docs.columns.index(text)
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded is not None:
        added.append(T.StructField(decoded, T.StringType()))
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, merges)
        for batch in batches:
            column = batch.column(place)
            for first, last, _, _ in utf8_parts(column, PART_BYTES):
                texts = column.slice(first, last - first).to_pylist()
                found = codec.encode_many([text or "" for text in texts])
                ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
                missing = pa.array([text is None for text in texts])
                ids_of = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")), mask=missing)
                columns = [*(c.slice(first, last - first) for c in batch.columns), ids_of]
                if decoded is not None:
                    columns.append(codec.decode_many(ids_of))
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        codec.remembered.clear()  # a worker that lives on should not hold what its tasks have met

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: Broadcast, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns with the text of ``ids`` as ``text``."""
    encoded = encoded.select(*[c for c in encoded.columns if c != text])
    place = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, True)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                column = part.column(place).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, codec.decode_many(column)], schema.names)

    return encoded.mapInArrow(run, schema)
