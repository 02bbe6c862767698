"""Operator 2, SentencePiece encoding and decoding by a weighted transducer.

A model file is compiled to three transducers.  The *normaliser* writes the dummy prefix, drops extra
white space if the model says so, and turns spaces into the meta symbol.  The *pieces* map strings to
ids; of a unigram model a piece weighs minus its score.  In a BPE model the states also remember the
last piece, and an arc is cut (weight infinite) unless merging the two pieces' characters leaves just
these two pieces: a sequence of pieces is the BPE encoding if and only if all neighbours are so, hence
the one path of weight zero is the encoding.  *Byte fallback* maps any other character to its bytes.
Composed with an input, the lattice is walked from left to right, keeping each state's least weight
(the tropical shortest path), in time linear in the text.

Places that no piece spans (before a meta symbol, around a character that is in no longer piece) are
cut vertices: every path meets them, so the shortest path is found for each part on its own, and
parts seen before are looked up, in a cache of bounded size.  If every single space is a cut vertex, a batch of
texts is split at spaces, each distinct word is encoded and decoded once, and the ids and the decoded words are
gathered by their places; texts with runs of spaces, a leading space or a meta symbol go through part by part.

Decoding joins the pieces, turns bytes back to characters (bytes that are not UTF-8 to U+FFFD) and
meta symbols to spaces, and drops the dummy prefix.  It restores every normalised text that doesn't
itself contain the meta symbol.

Null texts have null ids, empty texts none.  Repeated rows are encoded alike.  Extra columns don't matter.
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = "▁"
#: Distinct parts kept by a task's encoder, in each of two generations.
CACHE = 60_000
#: Distinct words kept with their ids.
WORDS = 400_000
#: Pairs of pieces of which it is kept whether they may be neighbours.
PAIRS = 400_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Session setting for another model file, in any store that Spark reads.
MODEL_CONF = "tessera.sentencepiece.model"
#: Bytes of text whose distinct words are encoded together.
CHUNK = 1 << 23

# Kinds of pieces and models in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


class Transducer:
    """The compiled normaliser, pieces and byte fallback of a model file's content."""

    def __init__(self, content: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict = {}
        rules: dict = {}
        for field, value in _fields(content):
            if field == 1:
                p = dict(_fields(value))
                self.pieces.append(p.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        self.bpe = trainer.get(3, UNIGRAM) == BPE
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE) or rules.get(2) or USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("only unigram and BPE models without character maps, user-defined and unused pieces are compiled")
        self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        if len(self.bytes) not in (0, 256):
            raise ValueError("byte fallback needs all 256 bytes")
        self.longest = max(map(len, self.ids), default=1)
        self.rare = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        order = sorted(self.ids.values(), key=lambda i: -self.scores[i])
        self.rank = {self.pieces[i]: r for r, i in enumerate(order) if len(self.pieces[i]) > 1}
        self._split: dict[str, tuple[str, str] | None] = {}
        self._beside: dict[tuple[str, str], bool] = {}
        self.spaced = False
        self._parts = self._cut_pattern()
        self._known: dict[str, tuple[int, ...]] = {}
        self._respelled: dict[str, str] = {}
        self._tree = self._piece_tree() if self.bpe else {}
        self._previous: dict[str, tuple[str, list[str | None]]] = {}
        self._inside = {x for p in self.ids for x in zip(p, p[1:])}
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        out = [p.replace(META, " ").encode() if k == NORMAL else b"" for p, k in zip(self.pieces, self.kinds)]
        for byte, i in self.bytes.items():
            out[i] = bytes([byte])
        out[self.unknown] = " ⁇ ".encode()
        self._spelling = out

    def _cut_pattern(self) -> re.Pattern:
        """Matches the parts of a normalised text between cut vertices."""
        inner = {ch for p in self.ids if len(p) > 1 for ch in p}
        spanned = any(META in p.lstrip(META) for p in self.ids)
        if not spanned:
            inner.discard(META)
        #: whether every space between two words is a cut vertex and stands in the normalised text
        self.spaced = not spanned and self.prefix and bool(self.bytes)
        word = "[" + "".join(map(re.escape, sorted(inner))) + "]" if inner else r"(?!)"
        return re.compile(f"{META}*{word}+|{META}+|.", re.S)

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", META)

    def merged(self, text: str, least: int = 1) -> list[str]:
        """What merging the best neighbours first (then the leftmost) leaves of a short string, or the
        first state with ``least`` parts."""
        parts = list(text)
        while len(parts) > least:
            best = max(((self.scores[i], -at) for at in range(len(parts) - 1) if (i := self.ids.get(parts[at] + parts[at + 1])) is not None), default=None)
            if best is None:
                break
            at = -best[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge joins to a piece; None if merging doesn't lead to it."""
        known = self._split.get(piece, self)
        if known is self:
            parts = self.merged(piece, 2)
            whole = len(parts) == 2 and len(self.merged(piece)) == 1
            known = self._split[piece] = (parts[0], parts[1]) if whole else None
        return known

    def _neighbours(self, a: str, b: str) -> bool:
        """Whether merging the characters of both leaves ``a, b``.

        Down the right edge of a's merge tree and the left edge of b's: two parts that lie side by
        side at some time must not be a better merge than the ones that use them up.  Of equal merges
        the left one comes first.
        """
        if a[-1] == META == b[0]:  # runs of the meta symbol all have one score
            return self.merged(a + b) == [a, b]
        get, rank = self.rank.get, self.rank
        ra, rb, limit = rank[a] if len(a) > 1 else -1, rank[b] if len(b) > 1 else -1, float("inf")
        while True:
            joined = get(a + b)
            if joined is not None and joined < limit:
                return False
            if ra > rb:
                limit, a = ra, self._halves(a)[1]
                ra = rank[a] if len(a) > 1 else -1
            elif rb >= 0:
                limit, b = rb + 0.5, self._halves(b)[0]
                rb = rank[b] if len(b) > 1 else -1
            else:
                return True

    def _fallback(self, ch: str) -> tuple[int, ...]:
        return tuple(self.bytes[x] for x in ch.encode()) if self.bytes else (self.unknown,)

    def _bpe_path(self, part: str) -> list[str]:
        """The path of weight zero; a state is (place, last piece), and a place has one such state, which depends on the
        part up to there only: of the part asked before with this first character, the common beginning is kept.
        Arcs into a place are followed backwards in the tree of reversed pieces; all but one are cut."""
        n, beside = len(part), self._beside
        if len(beside) > PAIRS:
            beside.clear()
        before, last = self._previous.get(part[0], ("", [None]))
        same = 0
        for x, y in zip(part, before):
            if x != y:
                break
            same += 1
        last = last[:same + 1] + [None] * (n - same)
        for end in range(same + 1, n + 1):
            arcs, begin = self._tree, end
            while begin:
                begin -= 1
                step = arcs.get(part[begin])
                if step is None:
                    if end - begin > 1:
                        break
                    arcs, piece = {}, part[begin]  # a character that is no piece
                else:
                    arcs, piece = step
                    if piece is None:
                        continue
                if begin:
                    left = last[begin]
                    if left is None:
                        continue
                    fits = beside.get((left, piece))
                    if fits is None:
                        fits = beside[left, piece] = self._neighbours(left, piece)
                    if not fits:
                        continue
                last[end] = piece
                break
        if last[n] is None:
            raise ValueError("no path")
        if n < 64:
            self._previous[part[0]] = part, last
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def _piece_tree(self) -> dict:
        """The pieces read backwards, as a tree: character to (tree of what comes before, piece or None).  Pieces
        that merging doesn't make have no arc."""
        root: dict = {}
        for piece in self.ids:
            if len(piece) > 1 and self._halves(piece) is None:
                continue
            at = root
            for i in range(len(piece) - 1, -1, -1):
                known = at.get(piece[i], ({}, None))
                at[piece[i]] = known = (known[0], piece if i == 0 else known[1])
                at = known[0]
        return root

    def _unigram_path(self, part: str) -> list[str]:
        n = len(part)
        best = [0.0] + [float("inf")] * n
        step = [0] * (n + 1)
        for begin in range(n):
            for end in range(begin + 1, min(n, begin + self.longest) + 1):
                i = self.ids.get(part[begin:end])
                if i is None and end - begin > 1:
                    continue
                cost = best[begin] - (self.scores[i] if i is not None else self.rare)
                if cost < best[end]:
                    best[end], step[end] = cost, begin
        out = []
        while n:
            out.append(part[step[n]:n])
            n = step[n]
        return out[::-1]

    def _at_cuts(self, part: str) -> list[str]:
        """The stretches of a part between the places where no piece holds both characters."""
        inside = self._inside
        if inside.issuperset(zip(part, part[1:])):
            return [part]
        out, begin = [], 0
        for at in range(1, len(part)):
            if (part[at - 1], part[at]) not in inside:
                out.append(part[begin:at])
                begin = at
        out.append(part[begin:])
        return out

    def path(self, part: str) -> tuple[int, ...]:
        """The ids along the shortest path through the lattice of a part without cut vertices."""
        out: list[int] = []
        for piece in (self._bpe_path if self.bpe else self._unigram_path)(part):
            i = self.ids.get(piece)
            out += (i,) if i is not None else self._fallback(piece)
        return tuple(out)

    def _stretch(self, part: str) -> tuple[int, ...]:
        found = self._old.get(part)
        if found is None:
            found = self.path(part)
        if len(self._young) >= CACHE:
            self._old, self._young = self._young, {}
        if len(part) < 64:
            self._young[part] = found
        return found

    def _part(self, part: str) -> list[int]:
        out: list[int] = []
        for x in self._at_cuts(part):
            out += self._young.get(x) or self._stretch(x)
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self._parts.findall(self.normalise(text)):
            out += self._young.get(part) or self._part(part)
        if not self.bytes:  # a run of unknown characters is one unknown piece
            out = [i for at, i in enumerate(out) if i != self.unknown or not at or out[at - 1] != i]
        return out

    def _shared(self, part: str) -> tuple[int, ...]:
        """The ids of a part, in the cache's own tuple if it has the whole part."""
        ids = self._part(part)
        return self._young.get(part) or tuple(ids)

    def _words(self, words: list[str]) -> tuple[list[tuple[int, ...]], list[str]]:
        """For each of some distinct words, the ids of the word with a space before it, and what they decode to.  Of
        the known ones only the ids are kept, in the tuple that the cache of parts has, and other spellings than their own."""
        known, fresh, odd = self._known, {}, {}
        for w in sorted(w for w in words if w not in known):  # those that begin alike come together
            parts = self._parts.findall(META + w)
            found = [self._young.get(part) or self._shared(part) for part in parts]
            fresh[w] = ids = found[0] if len(found) == 1 else tuple(chain.from_iterable(found))
            if (spelled := self._spelled(ids)) != " " + w:
                odd[w] = spelled
        other = self._respelled | odd if odd else self._respelled
        out = [known.get(w) or fresh[w] for w in words], [other.get(w) or " " + w for w in words]
        if len(known) + len(fresh) > WORDS:
            self._known, self._respelled = {}, {}
        self._known.update((w, x) for w, x in fresh.items() if len(w) < 64)
        self._respelled.update((w, x) for w, x in odd.items() if len(w) < 64)
        return out

    def plain(self, texts: pa.Array) -> pa.Array:
        """Which texts are words with single spaces between them, so that the words can be encoded by themselves."""
        if not self.spaced:
            return pa.array(np.zeros(len(texts), bool))
        odd = [pc.match_substring(texts, "  "), pc.starts_with(texts, " "), pc.match_substring(texts, META), pc.equal(pc.binary_length(texts), 0)]
        if self.squeeze:
            odd.append(pc.ends_with(texts, " "))
        out = odd[0]
        for x in odd[1:]:
            out = pc.or_(out, x)
        return pc.fill_null(pc.invert(out), False)

    def encode_plain(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(ids, decoded text) of ``plain`` texts: distinct words once, then gathered by their places."""
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        bounds = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        each, spelling = self._words(words.dictionary.to_pylist())
        size = np.array([len(i) for i in each], np.int64)
        ids = np.fromiter(chain.from_iterable(each), np.int32, int(size.sum()))
        code = words.indices.to_numpy()
        n, first = size[code], (np.cumsum(size) - size)[code]
        end = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(end[-1]) + np.repeat(first - end[:-1], n)
        spelled = pa.array(spelling, pa.large_string()).take(words.indices)
        bounds = bounds - bounds[0]
        _, offsets, data = spelled.buffers()  # the words lie end to end, so a text is the bytes between two of them
        offsets = np.frombuffer(offsets, np.int64)[spelled.offset:][bounds]
        text = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), data)
        return pa.LargeListArray.from_arrays(pa.array(end[bounds]), pa.array(ids[at])), pc.utf8_slice_codeunits(text, 1)

    def encode_all(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(ids, decoded text) of any texts; null for null ones."""
        plain = self.plain(texts)
        parts, order = [], []
        some = texts.filter(plain)
        if len(some):
            parts.append(self.encode_plain(some))
        odd = texts.filter(pc.invert(plain)).to_pylist()
        if odd:
            ids = [None if x is None else self.encode(x) for x in odd]
            parts.append((pa.array(ids, pa.large_list(pa.int32())), pa.array([None if i is None else self.decode(i) for i in ids], pa.large_string())))
        mask = plain.to_numpy(zero_copy_only=False)
        order = np.argsort(np.concatenate([np.flatnonzero(mask), np.flatnonzero(~mask)]))
        kinds = pa.large_list(pa.int32()), pa.large_string()
        return tuple(pa.concat_arrays([p[k] for p in parts] or [pa.array([], kinds[k])]).take(pa.array(order)) for k in (0, 1))

    def _spelled(self, ids: Sequence[int]) -> str:
        return b"".join(map(self._spelling.__getitem__, ids)).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self._spelled(ids)
        return text[1:] if self.prefix and text[:1] == " " else text

    def restored(self, text: str) -> str:
        """What decoding the encoding of a text must give (if all its characters are covered)."""
        out = self.normalise(text).replace(META, " ")
        return out[1:] if self.prefix and out[:1] == " " else out


@lru_cache(maxsize=2)
def compiled(content: bytes) -> Transducer:
    """The transducer of a model, one for each worker process."""
    made = Transducer(content)
    gc.freeze()
    return made


def model_content(spark, path: str) -> bytes:
    """A model file's bytes, read through Spark (any store that it knows); model files are small."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def model_path(spark) -> str:
    """The model file: the session setting ``MODEL_CONF``, else the public one that lies beside every executor here."""
    return spark.conf.get(MODEL_CONF, f"file://{MODEL}")


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows with up to ``CHUNK`` bytes of text, or of one longer text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        done = int(size[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + CHUNK, "right")))
        yield at, to - at
        at = to


def _encoded(content: bytes, passed: list[str]):
    def run(batches):
        gc.collect()  # the worker may have served other steps, whose buffers it still holds
        pa.default_memory_pool().release_unused()
        t = compiled(content)
        for b in batches:
            for at, n in _slices(b.column("text")):
                part = b.slice(at, n)
                texts = part.column("text")
                gc.disable()  # millions of small lists without cycles
                try:
                    ids, decoded = t.encode_all(texts)
                finally:
                    gc.enable()
                same = pc.equal(decoded, texts.cast(pa.large_string()))
                if t.squeeze:  # the normaliser drops spaces: decoding gives what is left
                    same = pa.array([None if x is None else x == t.restored(y) for x, y in zip(decoded.to_pylist(), texts.to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in passed), ids.cast(pa.list_(pa.int32())), pc.fill_null(pc.list_value_length(ids), 0).cast(pa.int64()), same, decoded.cast(pa.string())],
                                                 names=[*passed, "ids", "n_ids", "round_trip", "decoded"])
    return run


def encode(docs: DataFrame, content: bytes, passed: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the ``passed`` columns, ``ids, n_ids, round_trip, decoded``: the encoding of every whole text, the
    text that the ids decode to, and whether that is the normalised text.  A map over the rows; a worker keeps
    one compiled model."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *passed, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_encoded(content, ["doc_id", *passed]), f"{kinds}, ids array<int>, n_ids long, round_trip boolean, decoded string")


def decode(encoded: DataFrame, content: bytes) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids give a null text."""
    def run(batches):
        t = compiled(content)
        for b in batches:
            texts = [None if i is None else t.decode(i) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
