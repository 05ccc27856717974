"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

The pieces of a model and their log scores are taken from its file; nothing is trained. Pieces are
stored as UTF-8 in a double-array trie (arrays base, check and value). For a text the segmentation
with the highest sum of scores is found from left to right; a character that no piece begins with
alone may be an unknown one, at a penalty, and is written as byte pieces. Blanks are the marker
U+2581, with one in front of the text if the model asks for it; decoding turns them back.

No piece holds a marker behind another character, and none holds a line break, so the best path of a
text is made of the best paths of its runs between such places; runs met before come from a bounded
cache of the Python worker. If a model's pieces do cross these places, texts are one run each.

Scale: one map over whole texts; the trie and tables are broadcast and depend on the model only.
"""

from __future__ import annotations

import functools
import re
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from hexloom.llm.common import map_batches, prepare, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: What an unknown character costs below the lowest score; the value of the format's reader.
UNKNOWN_PENALTY = 10.0
#: Runs that a worker's cache holds, and what one batch of texts may add.
CACHE_SIZE = 150_000
#: Bytes of a run up to which many runs are searched at once, and how many are: some 8 MB of sums.
SHORT, ABREAST = 48, 8192


class DoubleArray:
    """A trie over byte strings: child of node s by byte c is t = base[s] + c + 1 where check[t] = s."""

    def __init__(self, keys: dict[bytes, int]):
        children: dict[bytes, list[int]] = {b"": []}
        for key in keys:
            for i in range(len(key)):
                head = key[:i + 1]
                if head not in children:
                    children[head] = []
                    children[key[:i]].append(key[i])
        size = 4 * len(children) + 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        # from 257 on every place can be reached by every byte
        free, later, queue = 257, 257, [(b"", 0)]
        for prefix, node in queue:
            codes = sorted(children[prefix])
            if prefix in keys:
                value[node] = keys[prefix]
            if not codes:
                continue
            while free < len(check) and check[free] >= 0:
                free += 1
            # nodes of one child fill the gaps; others go on from where the last of them found room
            start = max((free if len(codes) == 1 else max(free, later)) - codes[0] - 1, 0)
            while True:
                if start + 300 > len(base):
                    base += [0] * 65536
                    check += [-1] * 65536
                    value += [-1] * 65536
                if all(check[start + c + 1] < 0 for c in codes):
                    break
                start += 1
            if len(codes) > 1:
                later = start + codes[0] + 1
            base[node] = start
            for c in codes:
                check[start + c + 1] = node
                queue.append((prefix + bytes([c]), start + c + 1))
        base += [0] * 300
        check += [-1] * 300
        value += [-1] * 300
        self.base, self.check, self.value = (np.array(a, dtype=np.int32) for a in (base, check, value))


class Pieces:
    """A model's pieces: trie, scores, byte pieces, and the bytes that each id decodes to."""

    def __init__(self, serialized: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto.FromString(serialized)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave characters and blanks as they are")
        kinds = pb.ModelProto.SentencePiece
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.scores = [p.score for p in proto.pieces]
        plain = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.trie = DoubleArray({p.encode(): i for p, i in plain.items()})
        normal = [p.score for p in proto.pieces if p.type == kinds.NORMAL]
        self.unknown = min(normal, default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.unknown_id = next((i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN), 0)
        self.written = []
        for p in proto.pieces:
            if p.type == kinds.BYTE:
                self.written.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.UNKNOWN:
                self.written.append(" ⁇ ".encode())
            else:
                self.written.append(b"" if p.type == kinds.CONTROL else p.piece.replace(MARK, " ").encode())
        crossing = any(MARK in p.lstrip(MARK) or "\n" in p for p in plain)
        self.runs = re.compile(r"(?s).+" if crossing else rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")

    @functools.cached_property
    def _plain(self) -> tuple[list, list, list]:
        """The trie's arrays as lists, which single look-ups read faster."""
        return self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_plain"}

    def best_paths(self, runs: list[str]) -> list[bytes]:
        """The ids of each run's best path as little-endian 32-bit integers.

        Short runs walk the trie side by side, one byte of all of them at a time; sums and ties are those
        of best_path(), which long runs and runs with unknown characters take.
        """
        texts = [r.encode("utf-8", "surrogatepass") for r in runs]
        # runs of like length walk together
        short = sorted((k for k, t in enumerate(texts) if len(t) <= SHORT), key=lambda k: len(texts[k]))
        out: list[bytes | None] = [None] * len(runs)
        for low in range(0, len(short), ABREAST):
            some = short[low:low + ABREAST]
            sizes = np.array([len(texts[k]) for k in some])
            width = int(sizes.max())
            letters = np.zeros((len(some), width), dtype=np.int32)
            letters[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(texts[k] for k in some), dtype=np.uint8)
            for k, ids in zip(some, self._side_by_side(letters, sizes, width)):
                out[k] = ids
        return [ids if ids is not None else np.array(self.best_path(r), dtype="<i4").tobytes()
                for r, ids in zip(runs, out)]

    def _side_by_side(self, letters: np.ndarray, sizes: np.ndarray, width: int) -> list[bytes | None]:
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        scores, n = np.array(self.scores), len(sizes)
        best = np.full((width + 1, n), -np.inf)
        back, piece = np.zeros((width + 1, n), dtype=np.int32), np.full((width + 1, n), -1, dtype=np.int32)
        best[0] = 0
        for i in range(width):
            start = np.flatnonzero((best[i] > -np.inf) & (sizes > i))
            first = letters[start, i]
            step = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
            alone = np.zeros(n, dtype=bool)
            own, node, here, wide = start, np.zeros(len(start), dtype=np.int32), best[i, start], step
            for j in range(i, width):
                at = base[node] + letters[own, j] + 1
                on = (check[at] == node) & (sizes[own] > j)
                own, node, here, wide = own[on], at[on], here[on], wide[on]
                if not len(own):
                    break
                found = value[node]
                some = found >= 0
                alone[own[some & (wide == j + 1 - i)]] = True
                total = here + scores[np.where(some, found, 0)]
                some &= total > best[j + 1, own]
                into = own[some]
                best[j + 1, into], back[j + 1, into], piece[j + 1, into] = total[some], i, found[some]
            lone = ~alone[start]
            own, end, total = start[lone], i + step[lone], best[i, start[lone]] + self.unknown
            some = total > best[end, own]
            own, end = own[some], end[some]
            best[end, own], back[end, own], piece[end, own] = total[some], i, -1
        # from the ends back to the beginnings, all runs at once
        at, own, order, ids, strange = sizes.copy(), np.arange(n), [], [], np.zeros(n, dtype=bool)
        while len(own):
            found = piece[at, own]
            strange[own[found < 0]] = True
            order.append(own)
            ids.append(found)
            at = back[at, own]
            own, at = own[at > 0], at[at > 0]
        order, ids = np.concatenate(order)[::-1], np.concatenate(ids)[::-1].astype("<i4")
        data = ids[np.argsort(order, kind="stable")].tobytes()
        ends = 4 * np.cumsum(np.bincount(order, minlength=n))
        return [None if odd else data[a:b] for odd, a, b in zip(strange, [0, *ends[:-1].tolist()], ends.tolist())]

    def best_path(self, run: str) -> list[int]:
        """Ids of the best segmentation; of equal sums the one whose last pieces begin earlier."""
        text = run.encode("utf-8", "surrogatepass")
        n, lowest = len(text), float("-inf")
        base, check, value = self._plain
        scores = self.scores
        best, back, piece = [lowest] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == lowest:
                continue
            first = text[i]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            node, j, alone = 0, i, False
            while j < n:
                t = base[node] + text[j] + 1
                if check[t] != node:
                    break
                node = t
                j += 1
                found = value[t]
                if found >= 0:
                    if j - i == width:
                        alone = True
                    if here + scores[found] > best[j]:
                        best[j], back[j], piece[j] = here + scores[found], i, found
            if not alone and here + self.unknown > best[i + width]:
                best[i + width], back[i + width], piece[i + width] = here + self.unknown, i, -1
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in reversed(text[back[at]:at])]
            else:
                ids.append(self.unknown_id)
            at = back[at]
        return ids[::-1]

    def lookup(self, bound: int = CACHE_SIZE):
        """A function from texts to, for each, (ids as little-endian 32-bit integers, how many of them are
        byte pieces, whether they decode to the text), with a bounded cache of runs.

        A run is decoded once, when it is met first: pieces are joined byte by byte, so a text whose
        runs all come back comes back itself. The cache has two generations: a full younger one
        replaces the older, and runs met again move over, so frequent ones are never lost. Runs with
        byte pieces or that don't come back are few and stand in a table of their own.
        """
        young: dict[str, bytes] = {}
        old: dict[str, bytes] = {}
        odd: dict[str, tuple[int, bool]] = {}
        single = frozenset(self.byte_ids.values())

        def learn(runs: list[str]) -> None:
            for run, ids in zip(runs, self.best_paths(runs)):
                path = memoryview(ids).cast("i")
                n = 0 if single.isdisjoint(path) else sum(map(single.__contains__, path))
                back = b"".join(map(self.written.__getitem__, path)) == run.replace(MARK, " ").encode("utf-8", "surrogatepass")
                if n or not back:
                    odd[run] = (n, back)
                young[run] = ids

        def coded(text: str | None, runs: list[str]) -> tuple[bytes, int, bool]:
            ids = b"".join(map(young.__getitem__, runs))
            met = [odd[r] for r in runs if r in odd] if odd and not odd.keys().isdisjoint(runs) else []
            same = MARK not in (text or "")
            if not all(back for _, back in met):
                same = self.decode(memoryview(ids).cast("i")) == text
            return ids, sum(n for n, _ in met), same

        def encode(texts: list[str | None]) -> list[tuple[bytes, int, bool]]:
            nonlocal young, old, odd
            split = [self.runs.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
            new = set().union(*split).difference(young)
            again = new.intersection(old)
            young.update((r, old[r]) for r in again)
            learn(list(new - again))
            out = list(map(coded, texts, split))
            if len(young) > bound // 2:
                young, old = {}, young
                odd = {r: v for r, v in odd.items() if r in old}
            return out
        return encode

    def encoder(self, bound: int = CACHE_SIZE):
        """A function from text to ids as little-endian 32-bit integers."""
        encode = self.lookup(bound)
        return lambda text: encode([text])[0][0]

    def decode(self, ids) -> str:
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def load(path: str | None = None) -> Pieces:
    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path(MODEL))
    with open(path, "rb") as file:
        return Pieces(file.read())


def _appended(rows: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, column], names=[*rows.schema.names, name])


#: Of a worker, by model; the characters of a batch's texts that are looked up together, a longer text alone.
_lookups: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
TOGETHER = 500_000


def _together(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Consecutive texts of TOGETHER characters at most, or one text."""
    part, size = [], 0
    for text in texts:
        more = len(text or "")
        if part and size + more > TOGETHER:
            yield part
            part, size = [], 0
        part.append(text)
        size += more
    if part:
        yield part


def worker_lookup(model: Pieces):
    return _lookups.get(model) or _lookups.setdefault(model, model.lookup())


def encode_texts(docs: DataFrame, pieces: Pieces, column: str = "ids", verified: str | None = None,
                 singles: str | None = None) -> DataFrame:
    """The rows with the ids of their text, none for a null or empty text.

    With the name ``verified`` the same map also tells whether the ids decode to the text (null: empty),
    so no second worker holds the model; a text with the blanks' marker U+2581 does not come back. With
    the name ``singles`` it counts the ids of byte pieces. Rows and columns stay as they are; columns of
    the new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    kept = [c for c in docs.columns if c not in (column, verified, singles)]

    def make():
        own, at = shared.value, kept.index("text")
        # a worker keeps its broadcast values, and so its cache, from task to task
        encode = worker_lookup(own)

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts = rows.column(at).to_pylist()
            found = [x for part in _together(texts) for x in encode(part)]
            parts, n, same = zip(*found) if found else ((), (), ())
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
            out = _appended(rows, column, pa.ListArray.from_arrays(pa.array(ends), values))
            if verified:
                out = _appended(out, verified, pa.array(same, pa.bool_()))
            return _appended(out, singles, pa.array(n, pa.int64())) if singles else out
        return batch
    schema = docs.select(*kept).schema.add(column, ArrayType(IntegerType()))
    for name, kind in ((verified, "boolean"), (singles, "long")):
        schema = schema.add(name, kind) if name else schema
    return map_batches(docs.select(*kept), make, schema)


def decode_ids(rows: DataFrame, pieces: Pieces, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """The rows with the text that their ids spell; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)
    kept = [c for c in rows.columns if c != column]

    def make():
        own, at = shared.value, kept.index(ids)

        def batch(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [own.decode(x) if x else "" for x in part.column(at).to_pylist()]
            return _appended(part, column, pa.array(texts, pa.string()))
        return batch
    return map_batches(rows.select(*kept), make, rows.select(*kept).schema.add(column, "string"))


def ids_digest(ids: str) -> Column:
    """SHA-256 of the ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids), ",").cast("binary"), 256)


def op9_sentencepiece(spark, folder: str) -> DataFrame:
    """Encode every whole text and decode it back: doc_id, n_chars, n_ids, n_bytes (ids of byte
    pieces), ids_sha256 of the ids joined by commas, round_trip."""
    prepare(spark)
    pieces = load()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = encode_texts(docs, pieces, verified="round_trip", singles="n_bytes")
    return coded.select(
        "doc_id", F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_ids"),
        "n_bytes", ids_digest("ids").alias("ids_sha256"), "round_trip")


SQL = None
