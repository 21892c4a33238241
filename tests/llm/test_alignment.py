"""Token alignment against a plain version over whole texts."""

import collections
import hashlib
import random

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from shopflow.llm import alignment
from shopflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        # the usual byte alphabet, written out another way
        chars = {}
        extra = 0
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                chars[chr(byte)] = byte
            else:
                chars[chr(256 + extra)] = byte
                extra += 1
        self.chars = chars

    def tokens(self, text):
        if not text:
            return None
        enc = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.chars[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None

    def rows(self, docs):
        """(id, text) rows -> sorted result rows."""
        held = []
        count = collections.Counter()
        for d, t in docs:
            found = self.tokens(t)
            groups, links = [], []
            if found:
                ends = []
                for side in found:
                    at, e = 0, {}
                    for k, (_, x) in enumerate(side):
                        at += len(x)
                        e[at] = k
                    ends.append(e)
                last = (-1, -1)
                for end in sorted(set(ends[0]) & set(ends[1])):
                    i, j = ends[0][end], ends[1][end]
                    groups.append(",".join(str(x) for x, _ in found[0][last[0] + 1:i + 1]) + "|" + ",".join(str(x) for x, _ in found[1][last[1] + 1:j + 1]))
                    links.append((found[0][i][0], found[1][j][0]))
                    last = (i, j)
            count.update(links)
            held.append((d, found, groups, links))
        high = collections.Counter()
        for (_, b), n in count.items():
            high[b] = max(high[b], n)
        return sorted(((d, len(f[0]) if f else 0, len(f[1]) if f else 0, len(g), len(x), sum(count[p] == high[p[1]] for p in x), sum(count[p] for p in x),
                        hashlib.sha256(";".join(g).encode()).hexdigest() if f else "") for d, f, g, x in held), key=str)


def by_spark(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in alignment.align(df, **kw).collect()), key=str)


EDGE = ["", None, " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a   b\n\n\nc", "\nThe\n\nEnd", "tab\there\r\nand\r\n", "naïve İ K ｆｕｌｌ 😀 👩‍👩‍👧 words",
        "日本語の テキスト。中文 字符", "▁x y", "a▁", "<s> </s> <unk> <0x41> <|endoftext|> x", "\x00\x1f\x7f", "it's we'll 1234567 3.14!?..", "ｶﾞ é ​  x",
        "x" * 5000, "word " * 3000, "é" * 999, ");\r {\r\n", "𐍈𐍈 𐍈\n𐍈", "\xa0 nbsp \xa0\xa0x", "a\n b", "a \nb \n", "ab\n\n"]


def test_alignment_equals_the_plain_version_on_edges(spark):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(None, "a b"), (None, None), (3, "a  b"), (3, "a  b")]
    want = Plain().rows(rows)
    assert by_spark(spark, rows) == want
    assert by_spark(spark, rows, block_bytes=1) == want  # a block per document
    assert by_spark(spark, []) == []


def test_alignment_of_random_texts(spark):
    rng = random.Random(11)
    letters = "    \n\n\t\r\xa0abcdeTHe'’s.,;!?()1٣é²日本😀́ "
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))) for i in range(1500)]
    assert by_spark(spark, rows, block_bytes=4096) == Plain().rows(rows)


def test_alignment_query_equals_the_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_token_alignment"](spark, SF).collect()), key=str)
    assert got == Plain().rows(docs)


def test_groups_are_given_on_demand_and_hash_to_the_digest(spark):
    df = spark.createDataFrame([(1, "naïve 😀 text"), (2, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in alignment.align(df, with_groups=True).collect()}
    assert hashlib.sha256(rows[1]["groups"].encode()).hexdigest() == rows[1]["groups_sha256"] and rows[1]["groups"].count(";") == rows[1]["n_groups"] - 1
    assert rows[2]["groups"] == rows[2]["groups_sha256"] == ""


def test_coarse_cuts_are_refined_by_bytes():
    assert alignment.byte_ends([2, None, None, 7], [2, 1, 1, 3]) == [2, 3, 4, 7]
