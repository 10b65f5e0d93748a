import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import hashing, html_text, ngram_join, packing, pii, substring_dedup, toxicity
from textloom.llm.queries import QUERIES
from textloom.tables import table

WORD = re.compile("[^\x20\x09-\x0d]+")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# --- n-gram join


def brute_components(rows, size, per_cent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "per_cent", "orders"), [(3, 90, 3), (5, 80, 2), (1, 60, 2)])
def test_ngram_join_equals_brute_force(spark, size, per_cent, orders):
    rng = np.random.default_rng(size)
    rows = [(-1, None), (-2, ""), (-3, " \t"), (-4, "one two"), (-5, "One TWO"), (-6, "é"), (-7, "É")]
    for base in range(6):
        text = [f"w{x}" for x in rng.integers(0, 60 if base % 2 else 9000, 40 + 100 * base)]
        for copy in range(14):
            t = list(text)
            for at in rng.integers(0, len(t), copy * len(t) // 260):
                t[at] = f"e{rng.integers(0, 9)}"
            rows.append((len(rows), " ".join(t)))
    rows += [(1000 + i, rows[20][1]) for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = {r[0]: (r[1], r[2]) for r in ngram_join.ngram_join(d.repartition(5), size=size, per_cent=per_cent, orders=orders).select("doc_id", "n_shingles", "component_id").collect()}
    want = brute_components(rows, size, per_cent)
    assert len({c for _, c in want.values()}) < len(want) - 30
    assert got == want


def test_ngram_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    assert {r[0]: (r[1], r[2]) for r in QUERIES["op3_ngram_jaccard_join"](spark, DATA).collect()} == brute_components(rows, 3, 90)


@given(st.text(" \n\t\x0bab\x1cé ", max_size=60))
def test_words_are_cut_like_the_contract(t):
    assert len(hashing.word_hashes(t)) == len(WORD.findall(t))


def test_hashes_do_not_depend_on_tiles(monkeypatch):
    text = "ab c  déf " * 500
    whole = hashing.word_hashes(text)
    monkeypatch.setattr(hashing, "TILE", 64)
    assert (hashing.word_hashes(text) == whole).all()
    many, ends = hashing.many_word_hashes([b"a b", b"", b" c ", b"d"])
    assert ends.tolist() == [2, 2, 3, 4]
    assert (many == np.concatenate([hashing.word_hashes(x) for x in (b"a b", b"c", b"d")])).all()


def test_parity_maps_bound_differences():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    b = np.concatenate((a[10:], rng.integers(0, 2**63, 7).astype(np.uint64)))
    differ = sum(int(x & (2**64 - 1)).bit_count() for x in (ngram_join.parity_map(a) ^ ngram_join.parity_map(b)).tolist())
    assert 0 < differ <= 17


def test_empty_input(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_join(d).count() == 0
    assert substring_dedup.remove_repeats(d).count() == 0
    assert packing.pack_documents(d, VOCABULARY).count() == 0
    assert pii.pseudonymise(d, b"k").count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


# --- substring dedup


def brute_repeats(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j + k for j in range(len(w) - window + 1) if count[tuple(w[j : j + window])] > 1 for k in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("window", "seed"), [(35, 12), (6, 3)])
def test_repeats_equal_brute_force(spark, window, seed):
    rng = np.random.default_rng(window)
    words = lambda n, of=50: [f"w{x}" for x in rng.integers(0, of, n)]
    passages = [words(n) for n in (window - 1, window, window + 1, window + 9, 3 * window)]
    rows = [(0, None), (1, ""), (2, " ".join(words(window - 1))), (3, "De " * 200), (4, "De " * (window + 1)), (5, "a b " * 90)]
    for i in range(40):
        parts = words(int(rng.integers(0, 80)))
        for p in rng.integers(0, 5, 2):
            at = int(rng.integers(0, len(parts) + 1))
            parts[at:at] = passages[p]
        rows.append((6 + i, " ".join(parts)))
    rows += [(7, rows[7][1]), (7, "other text"), (99, rows[12][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.remove_repeats(d.repartition(4), window=window, seed=seed).collect())
    assert got == brute_repeats(rows, window)


# --- packing


ENCODER, TOKENIZER = packing.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)


def plain_ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizer():
    for t in ["", "a\x1cb c", "İstanbul ΑΣ Σ  x", "x's don't WE'LL", "é café ́", "日本語 デ", "12345 a1b2 a.b, c,", "ZÉBRÉ, straße.", "wörd" * 40, "\n\t ", "<|endoftext|>", "a <|startoftext|>b", "<|ENDOFTEXT|>", "won.$$$ ,. a., x²y ªº.", "\xa0a\x85b"] * 2:
        assert np.frombuffer(ENCODER(t), "<u4").tolist() == plain_ids(t)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("aAbtTsSéÉßµªº²½_.,,'!$-0<|> \n\x1c\xa0"), max_size=40))
def test_encoder_equals_tokenizer_on_any_text(t):
    assert np.frombuffer(ENCODER(t), "<u4").tolist() == plain_ids(t)


def test_encoder_forgets_what_is_not_used(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    encode = packing.Encoder(VOCABULARY)
    for t in ["a b c d e f g. H, a", "g a 7% x", "b c d e"]:
        assert np.frombuffer(encode(t), "<u4").tolist() == plain_ids(t)
    assert len(encode.words) <= 3 and len(encode.words.older) <= 3


def test_encoder_learns_a_word_once_however_it_is_written():
    encode, texts = packing.Encoder(VOCABULARY), ["Haus haus, HAUS. (haus)!? Haus's", "haus,haus\tHAUS!?", "日 HAUS. haus,"]
    for t in texts[:2]:
        assert np.frombuffer(encode(t), "<u4").tolist() == plain_ids(t)
    assert encode.words.keys() == {"haus", ",", ".", "(", ")!?", "!?", "'s"}
    assert np.frombuffer(encode(texts[2]), "<u4").tolist() == plain_ids(texts[2])


@pytest.mark.parametrize("together", [1, 40, 1 << 22])
def test_texts_taken_apart_together_equal_tokenizer(monkeypatch, together):
    monkeypatch.setattr(packing, "TOGETHER", together)
    texts = ["", "It's WE'LL 'said", "!'s ''t's's 're", "", "x²y7.5%", "日本 don't", "\x01'\x7f é\xa0b\x85c", "a <|endoftext|>b", "w'", "'ll", "a\x1cb", " \n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.many(texts)] == [plain_ids(t) for t in texts]
    assert list(ENCODER.many([])) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=255) | st.sampled_from("aAsStTrReEvVlLmMdD''!.1 "), max_size=30), max_size=6))
def test_texts_taken_apart_together_equal_tokenizer_on_any_texts(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.many(texts)] == [plain_ids(t) for t in texts]


def test_packing_query_equals_plain_tokenizer(spark):
    """Every piece, its place and checksum; each id of each document once, sequences without gaps and with little padding."""
    rows = QUERIES["op9_packing"](spark, DATA).collect()
    want = {r[0]: [*plain_ids(r[1] or ""), 1] for r in table(spark, DATA, "documents").select("doc_id", "text").collect()}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(want[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == want.keys()
    for held, end in [*((pieces[i], len(want[i])) for i in want), *((b, None) for b in bins.values())]:
        at = 0
        for start, length in sorted(held):
            assert start == at
            at += length
        assert at == end if end is not None else at == 2048 or at & (at - 1) == 0 and at < 2048
    assert sum(map(len, want.values())) == sum(n for b in bins.values() for _, n in b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 64), st.integers(1, 9), st.integers(1, 64), st.booleans())
def test_packing_loses_nothing_and_keeps_limits(sizes, tokens, segments, loss, cut):
    packer, bins, pieces = packing.Packer(tokens, segments, loss, cut, 5), defaultdict(list), defaultdict(list)

    def put(placed):
        for (example, _, start, length), sequence, offset, n in placed:
            bins[sequence].append((offset, length, n))
            pieces[example].append((start, length))

    for i, n in enumerate(sizes):
        put(packer.add(i, None, n))
    put(packer.drain())
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == n
    for held in bins.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at
            at += length
        assert at <= tokens and len(held) <= segments and sum(x[2] for x in held) <= loss


def test_packed_documents(spark):
    rows = [(1, "a b c"), (2, None), (2, ""), (3, "word " * 5000), (4, "é" * 30)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = packing.pack_documents(d, VOCABULARY, with_ids=True).collect()
    padding = Counter()
    for r in got:
        padding[r["sequence_id"]] += r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in padding.values())
    assert sum(r["length"] for r in got if r["doc_id"] == 3) == 5001
    assert sum(r["doc_tokens"] for r in got if r["doc_id"] == 2) == 2
    whole = b"".join(r["ids"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] == 1)
    assert np.frombuffer(whole, "<u4").tolist() == [*Tokenizer.from_file(VOCABULARY).encode("a b c", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize(("size", "length", "held"), [(1, 512, 512), (3, 1024, 342), (4, 2048, 512), (6, 2048, 342)])
def test_only_limits_close_a_sequence_of_short_texts(size, length, held):
    packer, bins = packing.Packer(2048, 512, 2048, True, 0), defaultdict(list)
    placed = [x for i in range(6000) for x in packer.add(i, None, size)] + list(packer.drain())
    for item, sequence, _, _ in placed:
        bins[sequence].append(item[3])
    whole = [sum(x) for x in bins.values()]
    assert sum(whole) == 6000 * size and Counter(whole)[length] >= len(whole) - 12
    assert max(map(len, bins.values())) == held


def test_a_bin_gives_back_more_than_the_pool_holds():
    packer, pieces = packing.Packer(2048, 512, 2048, True, 0), Counter()
    for i, n in enumerate([512, *[1] * 3000]):
        for item, *_ in packer.add(i, None, n):
            pieces[item[0]] += item[3]
    for item, *_ in packer.drain():
        pieces[item[0]] += item[3]
    assert pieces == {0: 512} | dict.fromkeys(range(1, 3001), 1)


def test_packed_conversations_stay_whole(spark):
    got = packing.pack_conversations(table(spark, DATA, "conversations"), VOCABULARY).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append(r)
        assert r["loss_tokens"] <= r["length"]
    for held in bins.values():
        assert sum(r["length"] for r in held) <= 2048 and len(held) <= 64 and sum(r["loss_tokens"] for r in held) <= 1536


# --- HTML


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("a<p>b<p>c", "a\n\nb\n\nc"), ("<ul><li>a<li>b<ol start=3><li>x</ol></ul>", "- a\n- b\n  3. x"), ("<table><tr><th>Name<th>Age<tr><td>Al<td>3</table>", "Name | Age\nAl   | 3"),
        ("x<script>var a='</p>'</script>y<style>.k{display:none}</style><b class=k>no</b>", "xy"), ("<p hidden>no</p><p style='display: NONE'>no</p>yes", "yes"), ("a &lt;b&gt; &amp;amp; 1 < 2", "a <b> &amp; 1 < 2"), ("<pre>\n a  b\n  c</pre>", " a  b\n  c"),
        ("<div>" * 3000 + "deep", "deep"), ("<a href=\"x>y\">l</a><br>m", "l\nm"), ("<head><title>t</title></head><body>b", "b"), ("<p>un<b>closed", "unclosed"), ("<!-- a > b -->c<!-- open", "c"), ("<dl><dt>T<dd>D</dl>", "T\n  D"),
    ],
)
def test_rendering(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<table><tr><td><p>a<p>b<ul><li>x<li>y</ul>c<br>d<pre>\n  k\n    l</pre></table>", "a\n\nb\n\n- x\n- y\n\nc\nd\n\n  k\n    l"),
        ("<table><tr><td>a<br>bcd<td>e<tr><td>f<td>g<br>h</table>", "a   | e\nbcd\nf   | g\n    | h"),
        ("<table><tr><td>o<table><tr><td>a<td>b<tr><td>cc<td>d</table><td>r</table>", "o      | r\n\na  | b\ncc | d"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c</tbody><tbody><tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>", "a |  | b\n  |  | c"),
        (f"<table><tr><td>{'x' * 70}<td>b<tr><td>c<td>d</table>", f"{'x' * 70} | b\n{'c':70} | d"),
        (f"<table><tr><td>{'word ' * 20}<td>b<tr><td>c<td>{'last ' * 20}</table>", f"{' '.join(['word'] * 12)} | b\n{' '.join(['word'] * 8)}\n{'c':59} | {' '.join(['last'] * 20)}"),
        ("<table><tr><td>a<td>x |</table>", "a | x |"), ("<table><tr><td><i>a</i> <b>b</b></table>", "a b"), ("<table><form><tr><td>a<td>b</form></table>", "a | b"),
        ("<table><tr><td>" * 2000 + "deep", "deep"),
        ("a<svg viewBox='0 0 1 1'><defs/><title>no</title><desc>no</desc><path d='M0'/><text>b</text><text>c</text></svg>d", "a b c d"), ("x <math><mi>y</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x y=1"),
        ("a<xmp>\n <b>k</b> &amp;\n  l</xmp>b", "a\n\n <b>k</b> &amp;\n  l\n\nb"),
        ("<style>@media print { .a{color:red} .y{display:none} } .z{color:red;display:none}</style><p class=y>y<p class=z>z", "y"),
        ("<style>@media (max-width:9px){.a{display:none}}@media screen{.b{display:none}}@media not print{.c{display:none}}/*.d{display:none}*/@keyframes k{p{visibility:hidden}}</style><p class=a>a<p class=b>b<p class=c>c<p class=d>d", "a\n\nd"),
        ("<style media=print>.a{display:none}</style><style>@import 'x}'; .b, .c{content:'}'; visibility : hidden }</style><i class=a>a</i><i class=b>b</i><i class=c>c</i>", "a"),
    ],
)
def test_layout_of_cells_and_what_is_visible(html, text):
    assert html_text.render(html) == text


def test_pages_keep_their_words(spark):
    pages = table(spark, DATA, "pages")
    texts = {r["page_id"]: r["text"] for r in QUERIES["op5_html_extraction"](spark, DATA).collect()}
    from html import unescape

    for r in pages.collect():
        body = re.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", "", r["html"])
        want = Counter(unescape(re.sub(r"</?(?:b|a)\b[^>]*>", "", body).replace("<", " <").replace(">", "> ") and re.sub(r"<[^>]+>", " ", re.sub(r"</?(?:b|a)\b[^>]*>", "", body))).split())
        have = Counter(texts[r["page_id"]].split())
        have.pop("-", None)
        want.pop("-", None)
        assert have == want


# --- PII


def test_surrogates_are_consistent_and_distinct(spark):
    rows = [
        (1, "Mrs Anna Weber (anna.weber@mail.example.com), +1 (017) 555-7713, card 4111 1111 1111 1111"), (2, "ANNA.WEBER@mail.example.com or (017) 555-7713; Frau Weber; 10.1.2.3 and 97.51.17.173"),
        (3, "Мария Иванова, DE89 3704 0044 0532 0130 00, 123-45-6789"), (4, None), (5, ""), (5, ""), (6, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + "plain text " * 2000),
    ]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash"))
    got = defaultdict(list)
    for r in pii.pseudonymise(d, b"k").collect():
        got[r["doc_id"]].append(r)
    spans = lambda i, kind: [got[i][0]["text"][s["start"] : s["end"]] for s in got[i][0]["entities"] if s["kind"] == kind]
    assert spans(1, "email") == spans(2, "email") and spans(1, "email")[0].endswith(".example")
    assert spans(1, "phone")[0] == "+1 " + spans(2, "phone")[0]
    assert spans(1, "last") == spans(2, "last")
    assert got[1][0]["text"].startswith("Mrs ")
    assert pii.luhn(re.sub(r"\D", "", spans(1, "card")[0])) == 0
    assert re.fullmatch("[А-Яа-я]+", spans(3, "given")[0])
    assert len({*spans(2, "ip"), "10.1.2.3", "97.51.17.173"}) == 4
    assert got[4][0]["text"] is None and len(got[5]) == 2
    assert "04dbebab" not in got[6][0]["text"] and got[6][0]["text"].endswith("plain text " * 2000)


def test_collisions_are_resolved(spark):
    forms = spark.createDataFrame([("ssn", f"{i:03d}") for i in range(450)], "kind string, form string")
    got = pii.assigned(forms, b"k").collect()
    assert len(got) == 450 == len({r["new"] for r in got})
    assert not {r["new"] for r in got} & {f"{i:03d}" for i in range(450)}


def test_no_entity_is_left(spark):
    before = {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}
    found = 0
    for r in QUERIES["op2_pii_surrogates"](spark, DATA).collect():
        for a, b, kind, _ in pii.entities(before[r["doc_id"]]):
            found += 1
            assert before[r["doc_id"]][a:b] not in r["text"] or kind == "phone"
    assert found > 10


def test_long_secrets_are_replaced_whole(spark):
    rng = np.random.default_rng(7)
    made = lambda n: "".join("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_."[i] for i in rng.integers(0, 65, n))
    head, tail = made(300), made(300)
    github = "ghp_" + "aB3" * 60
    rows = [(1, f"token={head}{tail} end"), (2, f"token={head}{made(300)} end"), (3, f"token: {head}{tail}, end"), (4, f"see {github} end")]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    assert all(len(r["entities"]) == 1 for r in got.values())
    new = {i: r["text"][r["entities"][0]["start"] : r["entities"][0]["end"]] for i, r in got.items()}
    assert len(new[1]) == 600 and got[1]["text"] == f"token={new[1]} end"
    assert new[1] == new[3] != new[2]
    assert not any(old[i : i + 20] in new[1] for old in (head, tail) for i in range(0, 280, 20))
    assert len(new[4]) == len(github) and github not in got[4]["text"]


def test_masked_secrets_are_no_entities(spark):
    masked = ["password: ********", "token: --------", "password=________", "secret: ••••••••••", "api_key: ****-****"]
    rows = [(i, t + " Frau Weber") for i, t in enumerate(masked)] + [(9, "password: !$%&/()=?"), (10, "password: a*******"), (11, "token: 1-------")]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(masked):
        assert [e["kind"] for e in got[i]["entities"]] == ["last"] and got[i]["text"].startswith(t + " Frau ")
    assert all([e["kind"] for e in got[i]["entities"]] == ["secret"] and got[i]["text"] != dict(rows)[i] for i in (9, 10, 11))
    assert "$%&" not in got[9]["text"]


def test_saturated_formats_are_filled(spark):
    # every value of a two-digit form, and every one of four digits in texts
    forms = spark.createDataFrame([(k, f"{i:02d}") for i in range(100) for k in ("ssn", "phone", "secret")], "kind string, form string")
    got = pii.assigned(forms, b"k").collect()
    assert len(got) == 300 == len({(r["kind"], r["new"]) for r in got})
    assert not {r["new"] for r in got} & {f"{i:02d}" for i in range(100)}
    rows = [(i, f"call +1 {i // 100:02d} {i % 100:02d} now") for i in range(10_000)]
    texts = {r["doc_id"]: r["text"] for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    assert len(set(texts.values())) == 10_000 and not set(texts.values()) & {t for _, t in rows}
    assert all(re.fullmatch(r"call \+1 \d\d \d{2,} now", t) for t in texts.values())


@pytest.mark.parametrize(("kind", "form"), [("ssn", "123456789"), ("card", "4111111111111111"), ("card", "4111111111111112"), ("iban", "DE89370400440532013000"), ("ip", "10.0.0.1"), ("phone", "2345"), ("secret", "a*******"), ("email", "a@b.cd"), ("given:f:latin", "anna"), ("last::cyrillic", "иванов")])
def test_late_proposals_leave_the_format(kind, form):
    assert all(len({len(pii.surrogate(b"k", kind, form, n)) for n in (0, n)}) == 2 for n in (300, 900))
    assert kind != "card" or (pii.luhn(pii.surrogate(b"k", kind, form, 300)) == 0) == (pii.luhn(form) == 0)


def test_longer_surrogates_are_rendered():
    assert pii.rendered("phone", "+1 23 45", "987654") == "+1 98 7654"
    assert pii.rendered("ssn", "123-45-6789", "9876543210") == "987-65-43210"
    assert pii.rendered("iban", "DE89 3704 0044 05", "DE99999999999988") == "DE99 9999 9999 9988"


def test_bare_names_of_a_document_are_replaced(spark):
    rows = [
        (1, "Weber came. Anna Weber called. Weber said ... Anna left, WEBER's car, Anna-Lena, Weber-Haus; weber annatto Annas anna.weber@mail.example.com"), (2, "Anna Weber wrote"), (3, "Weber and Anna have no other mention"),
        (4, "Mrs Smith-Jones met Мария Иванова. Smith-Jones left; Иванова и Мария; Jones"), (5, "Paul Anna said. Frau Anna. Anna"),
    ]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    spans = lambda i: [(e["kind"], got[i]["text"][e["start"] : e["end"]]) for e in got[i]["entities"]]
    (_, first), (_, last) = spans(2)
    assert got[1]["text"].startswith(f"{last} came. {first} {last} called. {last} said ... {first} left, {last.upper()}'s car, {first}-Lena, {last}-Haus; weber annatto Annas ")
    assert [k for k, _ in spans(1)] == ["last", "given", "last", "last", "given", "last", "given", "last", "email"]
    assert got[3]["text"] == rows[2][1]
    a, b, c = (x for _, x in spans(4)[:3])
    assert got[4]["text"] == f"Mrs {a} met {b} {c}. {a} left; {c} и {b}; Jones"
    assert len(spans(5)) == 4


# --- toxicity


def test_held_out_scores_tell_classes_apart(spark):
    d = "/root/testdata/sf0.1"
    met = QUERIES["op10_toxicity"](spark, d).join(table(spark, d, "labels"), "doc_id").where("held_out").toPandas()
    ranks = met["score"].rank()
    n1, n0 = (met["toxic"] == 1).sum(), (met["toxic"] == 0).sum()
    assert (ranks[met["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95
    assert met["score"].between(0, 1).all()
    assert (met["predicted"] == (met["score"] >= 0.5)).all()


def test_odd_rows_and_one_class(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "you idiot " * 5000)], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0)], "doc_id long, toxic int")
    out = toxicity.score(d, toxicity.fit(d, labels), only=["doc_id"])
    assert out.count() == 4
    assert toxicity.fit(d, labels.limit(0)).share == 0


def test_disguise_is_undone():
    assert toxicity.plain("1d!ot,") in (("idot", True), ("idiot", True))
    assert toxicity.plain("word.") == ("word", False)
    x = toxicity.Features(toxicity.Lexicon({"idiot$": (50, 0)}, 100, 100))("You IDIOT! fine")
    assert x[toxicity.FEATURES.index("strong_count")] > 0 and x[toxicity.FEATURES.index("near_second_person")] > 0


@pytest.mark.parametrize("n_second", [0, 1, 63, 64, 65, 500])
def test_nearness_is_exact_at_any_length(n_second):
    rng = np.random.default_rng(n_second)
    features = toxicity.Features(toxicity.Lexicon({"idiot$": (50, 0)}, 100, 100))
    near = lambda words: features(" ".join(words))[toxicity.FEATURES.index("near_second_person")]
    far = ["tu", "vas"] * n_second + ["mot"] * 50 + ["idiot", "mot"] * 3
    assert near(far) == 0
    mixed = rng.permutation(["tu"] * n_second + ["idiot"] * 40 + ["mot"] * (10 * n_second + 20)).tolist()
    want = sum("tu" in mixed[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1] for i, w in enumerate(mixed) if w == "idiot")
    assert near(mixed) == pytest.approx(np.log(1 + want))


def test_arrow_types_of_ids(spark):
    d = spark.createDataFrame([("a", "x y z"), ("b", "x y z")], "doc_id string, text string")
    assert {r["component_id"] for r in ngram_join.ngram_join(d).collect()} == {"a"}
    assert pa.array([1]).type == pa.int64()


def test_no_column_of_the_documents_meets_those_of_the_model(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(80)
    extra = {c: F.col("doc_id").cast("string") for c in ("prediction", "features", "raw", "x", "probability", "rawPrediction", "score", "predicted", "toxic_predicted", "_doc")}
    labels = table(spark, "/root/testdata/sf0.01", "labels").withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    clash = d.withColumns(extra)
    out = toxicity.drop_toxic(clash, labels)
    assert out.columns == clash.columns and all(r["score"] == r["predicted"] == r["raw"] == str(r["doc_id"]) for r in out.collect())
    model = toxicity.fit(d, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    assert {r["doc_id"]: r["score"] for r in toxicity.score(clash, model).collect()} == scores
