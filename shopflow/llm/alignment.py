"""Alignment of two tokenizers over the same texts: a byte-level BPE of the
``tokenizers`` library (A) and a BPE of ``sentencepiece`` with byte fallback (B).

Texts are cut where neither tokenizer ever joins what stands on both sides:
before a blank or a line end that follows a word.  Each distinct chunk is
aligned once.  The character offsets of A and the spans of B's proto are the
coarse cuts; tokens that end inside a character, and byte-fallback tokens, get
their ends from their decoded bytes.  Offsets where tokens of both end cut the
tokens into groups, and the two tokens that end there are linked.

Link counts over the corpus are a keyed sum: documents are dealt into blocks of
about BLOCK_BYTES of text, a block sends each id pair once with its count, and
gets back the pair's total and whether it is the highest of its B id.  No
table of pairs is ever broadcast or held by one task: a task holds the pairs of
its block.
"""

from __future__ import annotations

import gc
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import written
from shopflow.llm.tokens import _GROUP, _WS, default_tokenizer_path, distinct_parts, is_plain

BLOCK_BYTES = 1 << 20
CACHE, LONG = 400_000, 64
SHIFT = 32  # a pair's code: id of A << SHIFT | id of B
_SEAM = re.compile(f"(?<=[^{_WS}])(?=[ \\n])")
_MARK = "▁"
SIGNS = b".,;:!?)"
_SIGNED = re.compile(r"[A-Za-z][.,;:!?)]")


def default_piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_ends(coarse: list[int | None], widths: list[int]) -> list[int]:
    """End of each token: its coarse cut where it has one, else the end before
    it and its decoded bytes."""
    out, at = [], 0
    for cut, width in zip(coarse, widths):
        at = at + width if cut is None else cut
        out.append(at)
    return out


class Aligner:
    """Chunks to (tokens of A, tokens of B, groups, links, groups as text), or
    None where the decoded bytes of either are not the chunk's."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        symbol = _byte_of_symbol()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = bytes(symbol[c] for c in t) if all(c in symbol for c in t) else t.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_fallback = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b_fallback[i] else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.mark = self.b.piece_to_id(_MARK)
        # B joins across no blank or line end if no piece holds one after something else
        self.cuts = not any(_MARK in p.lstrip(_MARK) or "\n" in p for p in pieces) and not self.b.is_unknown(self.mark)
        # nor between an ASCII letter and a closing sign; A's pattern never does
        self.parts_signs = self.cuts and self.b.encode("a", return_type=str) == [_MARK + "a"] and not any(_SIGNED.search(p) for p in pieces)
        self.shown_a, self.shown_b = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(pieces))]
        self.known: dict[bytes, tuple | None] = {}
        self.signs: dict[bytes, tuple | None] = {}

    def chunks(self, text: str) -> list[bytes]:
        """The chunks of a blank and the text."""
        return [c.encode() for c in (_SEAM.split(" " + text) if self.cuts else [" " + text])]

    def _tokens_of_b(self, chunks: list[str]) -> list[tuple[list[int], list[int | None]]]:
        """Ids and coarse ends: the ends of the proto's spans, but of
        byte-fallback pieces none.  B puts a blank of its own before a text: it
        stands for the chunk's, or goes again where the chunk has none."""
        out = []
        fallback = self.b_fallback
        for c, proto in zip(chunks, self.b.encode([c[1:] if c[0] == " " else c for c in chunks], return_type="proto", num_threads=1)):
            shift = 1 if c[0] == " " else 0
            ids, ends = [], []
            for p in proto.pieces:
                i = p.id
                ids.append(i)
                ends.append(None if fallback[i] else p.end + shift)
            if c == " ":
                ids, ends = [self.mark], [1]
            elif not shift:
                ids, ends = (ids[1:], ends[1:]) if ids[:1] == [self.mark] else ([], [])
            out.append((ids, ends))
        return out

    def _ends_of_a(self, text: str, ids: list[int], spans: list[tuple[int, int]]) -> list[int]:
        """Ends in bytes: the character offsets of ASCII, else of those tokens
        that end a character."""
        if text.isascii():
            return [e for _, e in spans]
        place = [0]
        for ch in text:
            place.append(place[-1] + len(ch.encode()))
        last = len(spans) - 1
        coarse = [place[e] if k == last or spans[k + 1][0] >= e else None for k, (_, e) in enumerate(spans)]
        return byte_ends(coarse, [len(self.a_bytes[i]) for i in ids])

    def _align(self, chunk: bytes, text: str, ids_a: list[int], spans: list, ids_b: list[int], ends_b: list) -> tuple | None:
        a, b = self.a_bytes, self.b_bytes
        if b"".join([a[i] for i in ids_a]) != chunk or b"".join([b[i] for i in ids_b]) != chunk:
            return None
        ends_a = self._ends_of_a(text, ids_a, spans)
        if None in ends_b:
            ends_b = byte_ends(ends_b, [len(b[i]) for i in ids_b])
        shown_a, shown_b = self.shown_a, self.shown_b
        groups, links, ka, kb, j = [], [], 0, 0, 0
        n = len(ends_b)
        for i, end in enumerate(ends_a):
            while j < n and ends_b[j] < end:
                j += 1
            if j < n and ends_b[j] == end:
                j += 1
                groups.append(f"{','.join([shown_a[x] for x in ids_a[ka:i + 1]])}|{','.join([shown_b[x] for x in ids_b[kb:j]])}")
                links.append(ids_a[i] << SHIFT | ids_b[j - 1])
                ka, kb = i + 1, j
        return len(ids_a), len(ids_b), array("q", links).tobytes(), ";".join(groups)

    def _facts_of(self, keys: list[bytes]) -> list[tuple | None]:
        """Through the libraries."""
        out = []
        for lo in range(0, len(keys), 4096):
            some = keys[lo:lo + 4096]
            texts = [k.decode() for k in some]
            for k, t, a, (ids, ends) in zip(some, texts, self.a.encode_batch(texts, add_special_tokens=False), self._tokens_of_b(texts)):
                out.append(self._align(k, t, a.ids, a.offsets, ids, ends))
        return out

    def _sign(self, sign: bytes) -> tuple | None:
        """Facts of closing signs after a letter."""
        if sign not in self.signs:
            text = sign.decode()
            a = self.a.encode(text, add_special_tokens=False)
            (ids, ends), = self._tokens_of_b([" a" + text])
            self.signs[sign] = self._align(sign, text, a.ids, a.offsets, ids[1:], [e if e is None else e - 2 for e in ends[1:]])
        return self.signs[sign]

    def facts(self, keys: list[bytes]) -> list[tuple | None]:
        """Of distinct chunks.  Closing signs are aligned apart from their
        word, which is then often a known one."""
        out = [self.known.get(k, 0) for k in keys]
        at = [i for i, v in enumerate(out) if v == 0]
        words = [keys[i] for i in at]
        if self.parts_signs:
            bare = [k.rstrip(SIGNS) for k in words]
            words = [w if w[-1:].isalpha() else k for k, w in zip(words, bare)]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        fresh = dict(zip(new, self._facts_of(new)))
        for i, w in zip(at, words):
            word = fresh[w] if w in fresh else self.known[w]
            if len(w) < len(keys[i]):
                sign = self._sign(keys[i][len(w):])
                word = (word[0] + sign[0], word[1] + sign[1], word[2] + sign[2], f"{word[3]};{sign[3]}") if word and sign else None
            out[i] = word
        if len(self.known) < CACHE:
            self.known.update((w, f) for w, f in fresh.items() if len(w) <= LONG)
        if len(self.signs) > 10_000:
            self.signs.clear()
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker."""
    if (a_path, b_path) not in _LOADED:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def forget() -> None:
    _LOADED.clear()


def _pressed(numbers: np.ndarray, below: int) -> bytes:
    """Numbers under ``below``, in the fewest bytes."""
    return zstandard.compress(numbers.astype("<u2" if below <= 1 << 16 else "<u4").tobytes(), 1)


def _unpressed(data: pa.Buffer, below: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype="<u2" if below <= 1 << 16 else "<u4")


_DOC = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("groups_sha256", pa.string()), ("groups", pa.string()), ("parts", pa.binary())])
_BLOCK = ("block long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string, groups: string, parts: binary>>, "
          "n_chunks int, sizes binary, places binary, pairs array<long>, times array<long>")


def _block(ids: list[int | None], texts: list[str | None], tool: Aligner, with_groups: bool):
    """(docs, links per chunk, their places among the pairs, pairs, counts)."""
    plain = [i for i, t in enumerate(texts) if t and tool.cuts and is_plain(" " + t)]
    place: dict[bytes, int] = {}
    parts: dict[int, np.ndarray] = {}
    at = 0
    while at < len(plain):  # together up to _GROUP characters
        some, size = [], 0
        while at < len(plain) and (not some or size < _GROUP):
            some.append(plain[at])
            size += len(texts[plain[at]])
            at += 1
        data = [b" " + texts[i].encode() for i in some]
        keys, number, starts = distinct_parts(b"".join(data))
        number = np.array([place.setdefault(k, len(place)) for k in keys], dtype=np.int64)[number]
        cuts = np.searchsorted(starts, np.cumsum([0] + [len(d) for d in data])).tolist()
        parts.update((i, number[a:b]) for i, a, b in zip(some, cuts, cuts[1:]))
    for i, t in enumerate(texts):
        if t and i not in parts:
            parts[i] = np.array([place.setdefault(c, len(place)) for c in tool.chunks(t)], dtype=np.int64)
    facts = tool.facts(list(place))
    good = np.array([f is not None for f in facts], dtype=bool)
    n_a, n_b = (np.array([f[k] if f else 0 for f in facts], dtype=np.int64) for k in range(2))
    links = [f[2] if f else b"" for f in facts]
    sizes = np.array([len(x) // 8 for x in links], dtype=np.int64)
    groups = [f[3] if f else "" for f in facts]
    met = np.zeros(len(facts), dtype=np.int64)
    docs = []
    for i, doc in enumerate(ids):
        mine = parts.get(i)
        if mine is None or not good[mine].all():
            docs.append((doc, 0, 0, 0, "", "", b""))
            continue
        met += np.bincount(mine, minlength=len(met))
        shown = ";".join([groups[k] for k in mine.tolist()])
        docs.append((doc, int(n_a[mine].sum()), int(n_b[mine].sum()), int(sizes[mine].sum()), hashlib.sha256(shown.encode()).hexdigest(),
                     shown if with_groups else "", _pressed(mine, len(met))))
    pairs, places = np.unique(np.frombuffer(b"".join(links), dtype=np.int64), return_inverse=True)
    times = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(times, places, np.repeat(met, sizes))
    return docs, sizes, places, pairs, times


def _blocks(docs: DataFrame, doc_id: str, text: str, a_path: str, b_path: str, block_bytes: int, with_groups: bool) -> DataFrame:
    def run(batches):
        tool = aligner(a_path, b_path)
        first = TaskContext.get().partitionId() << 32
        ids, texts, size, made = [], [], 0, 0

        def emit():
            rows, sizes, places, pairs, times = _block(ids, texts, tool, with_groups)
            docs_ = pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _DOC)], fields=list(_DOC))
            whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), x)
            return pa.RecordBatch.from_arrays([
                pa.array([first + made], type=pa.int64()), whole(docs_), pa.array([len(sizes)], type=pa.int32()),
                pa.array([_pressed(sizes, 1 << 32)], type=pa.binary()), pa.array([_pressed(places, 1 << 32)], type=pa.binary()), whole(pa.array(pairs)), whole(pa.array(times))],
                names=["block", "docs", "n_chunks", "sizes", "places", "pairs", "times"])

        gc.disable()  # nothing here is cyclic, and each collection would walk the cache
        try:
            for batch in batches:
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    t = t.as_py()
                    ids.append(d), texts.append(t)
                    size += len(t or "") + 64
                    if size >= block_bytes:
                        yield emit()
                        ids, texts, size, made = [], [], 0, made + 1
            if ids:
                yield emit()
        finally:
            gc.enable()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, _BLOCK)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None,
          block_bytes: int = BLOCK_BYTES, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    per row, and ``groups`` (`a1,a2|b1;a3|b2,b3`) with ``with_groups``.

    A reads a blank and the text, B the text, before which it puts a blank.
    Null and empty texts, and texts whose decoded bytes differ from the blank
    and the text for A or B (B writes U+2581 as a blank), have no tokens: zeros,
    '' as their hash and groups.  Special-token strings are plain text.  Tokens
    that end at the same byte are linked; a pair's count is the number of links
    in the corpus that join its two ids; n_best counts the links whose pair has
    the highest count of all pairs of its B id, ties included.  Rows that repeat
    an id or a text are documents of their own, null ids are kept, an empty
    table gives no rows, and texts of any length are taken whole (one longer
    than a block is a block).  Other columns are not read."""
    blocks = written(_blocks(docs, doc_id, text, a_path or default_tokenizer_path(), b_path or default_piece_path(), block_bytes, with_groups), "aligned")
    pairs = (blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("pos", "p"))
             .select("block", "pos", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n")).filter("n > 0"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))
    highest = totals.groupBy("b").agg(F.max("total").alias("high"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("high")).alias("best"))
    back = (pairs.select("block", "pos", "pair").join(judged, "pair").groupBy("block")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "total", "best"))).alias("counts")))
    rows = blocks.select("block", "docs", "n_chunks", "sizes", "places").join(back, "block", "left").select("docs", "n_chunks", "sizes", "places", "counts")

    def run(batches):
        forget()  # the first pass is over: a worker that ran it gives its memory back
        for batch in batches:
            for k in range(batch.num_rows):
                docs_ = batch.column(0).slice(k, 1).flatten()
                n_chunks = batch.column(1)[k].as_py()
                sizes = _unpressed(batch.column(2)[k].as_buffer(), 1 << 32).astype(np.int64)
                places = _unpressed(batch.column(3)[k].as_buffer(), 1 << 32)
                counts = batch.column(4).slice(k, 1).flatten()
                total, best = np.zeros((2, int(places.max()) + 1 if len(places) else 0), dtype=np.int64)
                at = counts.field("pos").to_numpy()
                total[at] = counts.field("total").to_numpy()
                best[at] = counts.field("best").to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                per = [np.diff(np.append(0, np.append(0, np.cumsum(x[places]))[ends])) for x in (total, best)]  # of each chunk
                mine = [_unpressed(p.as_buffer(), n_chunks) if len(p.as_buffer()) else [] for p in docs_.field("parts")]
                n_best = pa.array([int(per[1][m].sum()) for m in mine], type=pa.int64())
                summed = pa.array([int(per[0][m].sum()) for m in mine], type=pa.int64())
                f = docs_.field
                cols = [f("doc_id"), f("n_a"), f("n_b"), f("n_groups"), f("n_groups"), n_best, summed, f("groups_sha256"), f("groups")]
                yield pa.RecordBatch.from_arrays(cols[:len(names)], names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * with_groups
    schema = ", ".join(f"{c} {'string' if c.startswith('groups') else 'long'}" for c in names)
    return rows.mapInArrow(run, schema)
