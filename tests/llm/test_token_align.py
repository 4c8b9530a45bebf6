import hashlib
from collections import Counter, defaultdict

import pytest
from costmart.llm import queries, token_align

SF = "/root/testdata/sf0.001"
FILES = f"{token_align.TOKENIZERS}/{token_align.A_FILE}", f"{token_align.TOKENIZERS}/{token_align.B_FILE}"


@pytest.fixture(scope="module")
def tok():
    return token_align.Tokenizers(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())


def pieces(text):
    """[(id, bytes)] of both tokenizations of the whole text, by the libraries' own decoding."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    symbols = token_align._byte_of_symbol()
    enc = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(symbols[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return left, right


def one(text):
    """(n_a, n_b, groups text, links) of a text, token by token; None without tokens."""
    if not text:
        return None
    a, b = pieces(text)
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None

    def spans(tokens):
        at, out = 0, []
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    a, b = spans(a), spans(b)
    common = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, first = [], 0
    for stop in common:
        groups.append([[str(i) for i, s, e in side if first <= s and e <= stop] for side in (a, b)])
        first = stop
    links, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return len(a), len(b), ";".join("|".join(map(",".join, g)) for g in groups), links


def brute(rows):
    found = {t: one(t) for t in {t for _, t in rows}}
    count = Counter()
    for _, t in rows:
        if found[t]:
            count.update(set(found[t][3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, t in rows:
        if not found[t]:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found[t]
        best = sum(count[p] == most[p[0]] for p in links)
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out.append((i, n_a, n_b, groups.count(";") + 1, len(links), best, sum(count[p] for p in links), sha))
    return sorted(out, key=str), count, most


def got(alignment):
    rows = alignment.documents.select("row.doc_id", *token_align.MEASURES, "groups_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op12_token_align(spark, SF).collect()), key=str) == brute(rows)[0]


TEXTS = [
    "plain words here", "plain words here", " two  spaces\n\tand tabs ", "<|endoftext|> <s> </s> <unk>", "▁ is a piece mark",
    "naïve café — 日本語 😀 ﬁ ½", "\x00\x01 control", "ends in space ", "x", " ", "\n", "''s can't won't", "a" * 300, "é combining",
]


@pytest.mark.parametrize("block", [1 << 21, 20])
def test_odd_texts_and_blocks(spark, block):
    rows = list(enumerate(TEXTS)) + [(50, None), (51, ""), (None, "plain words here"), (7, "ends in space ")]
    df = spark.createDataFrame([(i, t, "x", 1, "d") for i, t in rows], "doc_id long, text string, row string, n_a int, digest string")
    found = token_align.align(df, block_pairs=block)
    expected, count, most = brute(rows)
    assert got(found) == expected
    pairs = {(r["a"], r["b"]): (r["n"], r["best"]) for r in found.pairs.collect()}
    assert pairs == {p: (n, n == most[p[0]]) for p, n in count.items()}


def test_a_hot_text_and_merged_counts(spark, monkeypatch):
    monkeypatch.setattr(token_align, "MERGE", 10)
    rows = [(i, "the same text again" if i % 3 else f"text number {i}") for i in range(200)]
    found = token_align.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert got(found) == brute(rows)[0]


def test_cuts_change_nothing(spark, tok, monkeypatch):
    """Long texts cut at spaces give the tokens of the whole text."""
    assert tok.cuts
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()
    texts = [r.text for r in docs] + TEXTS + [" ".join(t for t in TEXTS) * 5]
    whole = token_align.Aligner(tok, texts)
    monkeypatch.setattr(token_align, "PART", 20)
    monkeypatch.setattr(token_align, "BYTES", 100)
    cut = token_align.Aligner(tok, texts)
    assert sum(len(list(tok.parts(t))) for t in texts) > 10 * len(texts)
    assert cut.sha == whole.sha and (cut.counts == whole.counts).all()
    assert (cut.pair == whole.pair).all() and (cut.times == whole.times).all() and (cut.offsets == whole.offsets).all()


def test_texts_that_tokens_do_not_give_back(tok, monkeypatch):
    monkeypatch.setattr(tok, "faithful", lambda parts, a, b: ["bad" not in p for p in parts])
    monkeypatch.setattr(token_align, "PART", 5)
    found = token_align.Aligner(tok, ["good words", "some words then bad words and more", None, ""])
    assert found.counts[:, 1:].sum() == 0 and found.counts[0, 0] > 0
    assert found.sha[1:] == ["", "", ""] and found.offsets.tolist()[1:] == [len(found.pair)] * 4


def test_joined_bytes(tok):
    a, b = tok.encode(["one two", "ümlaut"])
    assert tok.faithful(["one two", "ümlaut"], a, b) == [True, True]
    assert tok.faithful(["one twO", "ümlaut"], a, b) == [False, True]
    assert tok.faithful(["one two", "ümlaut"], a, [b[0], b[0]]) == [True, False]
    assert tok.faithful(["one two", "ümlaut"], [a[0], a[1][:0]], b) == [True, False]


def test_both_encoders_of_the_file_agree(tok, monkeypatch):
    """Ids by merge rank are those of the tokenizer that the file defines."""
    assert tok.ranked is not None
    texts = TEXTS + ["a" * 5000, " " * 5000, "ab" * 3000, "!?" * 2000, "\n" * 3000, "x" + " " * 1_000_000 + "y", "".join(map(chr, range(1, 0x3000)))]
    fast = [list(map(int, x)) for x in tok.encode(texts)[0]]
    monkeypatch.setattr(tok, "ranked", None)
    assert fast == tok.encode(texts)[0]


def test_a_file_that_merges_out_of_order_is_not_ranked():
    import json

    definition = json.loads(open(FILES[0], encoding="utf-8").read())
    assert token_align._merges_follow_ids(definition)
    definition["model"]["merges"][:2] = definition["model"]["merges"][1::-1]
    assert not token_align._merges_follow_ids(definition)


def test_empty(spark):
    found = token_align.align(spark.createDataFrame([], "doc_id long, text string"))
    assert found.documents.count() == 0 and found.pairs.count() == 0


def test_only_the_text_column(spark):
    found = token_align.align(spark.createDataFrame([("a b",), (None,)], "text string"))
    assert sorted(r.n_a for r in found.documents.collect()) == [0, 2]
