"""Token alignment against a plain version that encodes whole texts with both libraries."""

import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chartlake.llm import alignment
from chartlake.llm.queries import QUERIES
from tests.llm.test_operators import ROWS, SCHEMA, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    " ", "  ", "a ", " a", "a  b   c", "\n", "x\n\ny\t z\r\n", "<s> </s> <unk> <0x41> <|endoftext|>", "a▁b", "▁", "é́ ﬁ 漢字 漢 字", "日本語テキスト" * 40,
    "\x00 nul", "don't we'll I'M", "emoji 👩‍👩‍👧 ok", "  hard blank   em", "same text", "same text", "same text", "word " * 3000, "y" * 3000,
]


def plain(rows):
    """Rows in the result's order of columns, from whole texts and byte offsets."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment.byte_letters()
    parts, count = [], collections.Counter()
    for id, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            parts.append((id, None))
            continue

        def ranges(tokens):
            at, out = 0, []
            for t in tokens:
                out.append((at, at + len(t)))
                at += len(t)
            return out

        at_a, at_b = ranges(bytes_a), ranges(bytes_b)
        over = [[] for _ in range(at_a[-1][1])]
        for j, (x, y) in enumerate(at_b):
            for k in range(x, y):
                over[k] = j
        links = sorted({(i, over[k]) for i, (x, y) in enumerate(at_a) for k in range(x, y)})
        cuts = sorted({y for _, y in at_a} & {y for _, y in at_b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            own_a, own_b = [], []
            while i < len(at_a) and at_a[i][1] <= cut:
                own_a.append(str(ids_a[i]))
                i += 1
            while j < len(at_b) and at_b[j][1] <= cut:
                own_b.append(str(ids_b[j]))
                j += 1
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        count.update(set(pairs))
        parts.append((id, (len(ids_a), len(ids_b), groups, pairs)))
    highest = collections.Counter()
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for id, part in parts:
        if part is None:
            out.append((id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = part
        best = sum(count[p] == highest[p[0]] for p in pairs)
        out.append((id, n_a, n_b, len(groups), len(pairs), best, sum(count[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr), {(a, b): (n, n == highest[a]) for (a, b), n in count.items()}


@pytest.mark.parametrize("slice_bytes", [1 << 20, 500])
def test_matches_plain_version(spark, slice_bytes):
    rows = ROWS + [(1000 + k, x) for k, x in enumerate(ODD)] + [(1000, ODD[4]), (None, "no id here"), (None, None)]
    expected, pairs = plain(rows)
    documents, counts = alignment.aligned(table(spark, rows, 5), A, B, slice_bytes=slice_bytes)
    assert sorted([tuple(r) for r in documents.collect()], key=repr) == expected
    assert {(r["a"], r["b"]): (r["count"], r["best"]) for r in counts.collect()} == pairs
    # A blank of its own kind, or a piece that isn't its bytes, has no tokens.
    assert sum(r[1] == 0 for r in expected) >= 4


def test_empty_table(spark):
    documents, counts = alignment.aligned(spark.createDataFrame([], SCHEMA), A, B)
    assert documents.count() == counts.count() == 0
    assert all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in alignment.aligned(table(spark, [(1, None), (2, "")]), A, B)[0].collect())


def test_whole_parts_where_cuts_are_not_safe(monkeypatch):
    worker = alignment.Aligner(A, B)
    assert worker.cuts
    texts = ["one two\nthree  four", "a b"]
    cut = worker.texts(texts)
    whole = alignment.Aligner(A, B)
    whole.cuts = False
    uncut = whole.texts(texts)
    assert (cut[0] == uncut[0]).all() and cut[1] == uncut[1]


def test_forgets(monkeypatch):
    worker = alignment.Aligner(A, B)
    first = worker.texts(["one two three"])
    monkeypatch.setattr(alignment, "PARTS", 1)
    again = worker.texts(["one two three"])
    assert (first[0] == again[0]).all() and first[1] == again[1]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in QUERIES["op13_token_alignment"](spark, sf).collect()], key=repr) == plain(rows)[0]


def test_parts_are_encoded_in_runs():
    """As each by itself, also where a part ends in blanks or does not end visibly; far fewer calls of the library than parts."""
    own = alignment.Aligner(A, B)
    parts = [" a", " b.", "  c", " ", "\n", " d\n ", " e", " 漢字", " f", "  ", " don't", " x<s>", " é"] + [f" w{k}" for k in range(9000)]
    lengths = alignment.np.array([len(p.encode()) for p in parts])
    calls, library = [], own.a._library
    own.a._library = lambda texts: calls.append(len(texts)) or library(texts)
    ids, sizes = own.a.encode(parts, lengths)
    upto = alignment.np.cumsum(sizes).tolist()
    assert [ids[x:y].tolist() for x, y in zip([0, *upto], upto)] == library(parts)
    assert sum(calls) < 20
