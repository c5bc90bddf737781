"""Fingerprints, PII, toxicity, licenses and piece encoding against plain forms."""

import hashlib
import math
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitlake.llm import fingerprints as fp
from pitlake.llm import licenses, pii, toxicity
from pitlake.llm.pieces import MODEL, Encoder, Vocabulary, decode_documents, encode_documents, encoder
from pitlake.llm.shingles import MinHash, Shingler, overlap

ODD = [None, "", " ", "a", "a b", "x" * 30_000, "word " * 5_000, "日本語 😀 ñ", "a\x00b", "\n\n\t x  y \r\n"]


def docs(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


# -- fingerprints ---------------------------------------------------------------------------


def plain_fingerprints(rows):
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text = text or ""
        following = order[(i + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        out[doc_id] = (n, hashlib.sha256(edited.encode()).hexdigest(), fp.fingerprint(text), fp.fingerprint(edited), fp.likeness(fp.fingerprint(text), fp.fingerprint(edited)), fp.likeness(fp.fingerprint(text), fp.fingerprint(following)))
    return out


def test_fingerprints_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_BYTES", 5000)
    texts = [*ODD, "same text", "same text", "the quick brown fox " * 20, "the quick brown fox " * 20 + "end"]
    got = fp.fingerprint_documents(docs(spark, texts, part=7, context="x")).collect()
    want = plain_fingerprints(list(enumerate(texts)))
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) == want[r["doc_id"]]


def test_fingerprints_of_null_ids_repeats_and_nothing(spark):
    df = spark.createDataFrame([(None, "abc"), (None, "abc"), (5, "xyz"), (5, "xyz")], "doc_id long, text string")
    got = fp.fingerprint_documents(df).collect()
    assert len(got) == 4
    assert {r["edited_sha256"] for r in got if r["doc_id"] is None} == {hashlib.sha256(b"ab").hexdigest()}
    assert fp.fingerprint_documents(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=40), st.text("ab", max_size=40), st.data())
def test_shared_is_the_longest_prefix_and_suffix(a, b, data):
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
    tail = min(tail, min(len(a), len(b)) - head)
    want = 1.0 if a == b else (head + tail) / max(len(a), len(b))
    assert fp.shared(fp.text_prefixes(a), fp.text_prefixes(b)) == want
    assert fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) == pytest.approx(want, abs=0.42)
    if max(len(a), len(b)) <= 8 and head + tail < max(len(a), len(b)):
        assert fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) == pytest.approx(want)


@pytest.mark.parametrize("a, b, want", [("a", "aaa", 1 / 3), ("ab", "abab", 1 / 2), ("aa", "aaaaaaaa", 1 / 4), ("", "aa", 0.0), ("ab", "cb", 1 / 2)])
def test_a_prefix_and_suffix_that_overlap_count_once(a, b, want):
    for x, y in ((a, b), (b, a)):
        assert fp.likeness(fp.fingerprint(x), fp.fingerprint(y)) == pytest.approx(want)
        assert fp.shared(fp.text_prefixes(x), fp.text_prefixes(y)) == pytest.approx(want)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=40), st.text("ab", max_size=40), st.data())
def test_spans_and_extensions(a, b, data):
    x, y = fp.text_prefixes(a), fp.text_prefixes(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert fp.longest_extension(x, i, y, j) == n
    assert (fp.fingerprint(a) == fp.fingerprint(b)) == (a == b)
    assert 0 <= fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) <= 1


# -- personal data --------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


PRIVATE = [
    "mail a@b.c_d@e.f and x.y+z@mail5.example.com.", "ip 1.2.3.4.5 999.1.1.1 010.000.255.255 1.2.3.4", "card 4465758382889437 4465 7583 8288 9437 4465-7583-8288-9438 4111111111111111",
    "+1 (743) 555-3824 éeux +12 +1234567890123456", "iban GB82 WEST 1234 5698 7654 32 and DE89370400440532013000", "ssn 123-45-6789 but the other number in this very long line of plain words is 123-45-6788",
    "1 " * 3000, "9" * 5000, "a@" * 2000, "a.b" * 3000 + "@x.y", "😀 a@b.cd 😀 1.1.1.1",
]


def test_base_spans_agree_with_plain_patterns(spark):
    texts = [*ODD, *PRIVATE]
    for r in pii.scan_documents(docs(spark, texts, found="x", n_email=3)).collect():
        want = plain_spans(texts[r["doc_id"]] or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), texts[r["doc_id"]]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[3] == k for s in want) for k in ("email", "ip", "card", "phone")]
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("0123456789. -+@ab()%_", max_size=60), min_size=1, max_size=20))
def test_random_texts_agree_with_plain_patterns(texts):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    for r in pii.scan_documents(docs(spark, texts)).collect():
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in plain_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), texts[r["doc_id"]]


def test_added_kinds_need_checksum_or_context(spark):
    got = {r["doc_id"]: r for r in pii.scan_documents(docs(spark, PRIVATE)).collect()}
    assert got[4]["spans"].count("iban") == 2
    assert got[5]["spans"].count("ssn") == 1  # the bare one and the one far from its context stay out


@pytest.mark.parametrize(("piece", "kind"), [("a@b.co ", "email"), ("1.1.1.1 ", "ip"), ("+1 234 567 8901; ", "phone")])
def test_texts_of_many_matches(spark, piece, kind):
    text = piece * 30_000
    row = pii.scan_documents(docs(spark, [text])).first()
    listed = ",".join(f"{kind}:{i * len(piece)}:{i * len(piece) + len(piece.rstrip(' ;'))}" for i in range(30_000))
    assert row[f"n_{kind}"] == 30_000 and row["spans"] == listed
    clean = pii.redact_documents(docs(spark, [text])).first()["text"]
    assert clean == piece.replace(piece.rstrip(" ;"), f"<{kind.upper()}>") * 30_000


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(1, 30)), max_size=300))
def test_redaction_of_overlapping_spans(found):
    from pyspark.sql import SparkSession

    text = "".join(chr(97 + i % 26) for i in range(450))
    spans = sorted((a, a + n) for a, n in found)
    want, at = "", 0
    for a, b in spans:
        if a >= at:
            want += text[at:a] + "<X>"
        at = max(at, b)
    want += text[at:]
    df = SparkSession.getActiveSession().createDataFrame([(text, [(a, 0, b, "x", 1.0) for a, b in spans])], f"text string, spans array<{pii._SPAN}>")
    assert df.select(pii.redact(F.col("text"), F.col("spans")).alias("t")).first()["t"] == want


def test_redaction(spark):
    df = docs(spark, ["write to a@b.cd now", None, "plain"], n_chars=0, lang="en", __spans="s", spans="t", row=1)
    got = {r["doc_id"]: r for r in pii.redact_documents(df).collect()}
    assert got[0]["text"] == "write to <EMAIL> now" and got[0]["n_chars"] == 20
    assert got[1]["text"] is None and got[2]["text"] == "plain"
    assert pii.redact_documents(df).columns == df.columns
    assert {(r["__spans"], r["spans"], r["row"]) for r in got.values()} == {("s", "t", 1)}


# -- toxicity -------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "want"), [("1d10t", "idiot"), ("MоrоN", "moron"), ("$cum", "scum"), ("call 555 1234!", "call 555 1234!"), ("clo​wn", "clown")])
def test_folding(text, want):
    assert toxicity.fold(text) == want


def test_matching_is_by_word_and_spares_exceptions():
    model = toxicity.Model(weights={"trash ": 5.0, "lowei": 4.0})
    matcher = model.automaton()
    hit = lambda t: model.features(t, matcher)[0] > 0
    assert hit("you are tr4sh") and hit("so loweisch") and not hit("trashes") and not hit("untrash") and not hit("the trash can")
    assert model.features(None, matcher) == (0.0, 0.0) == model.features("", matcher)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["trash", "trash can", "can", "can trash", "trashed", "x", "tr4sh", "idiot proof", "idiot"]), max_size=30))
def test_matches_agree_with_naive_matching(words):
    model = toxicity.Model(weights={"trash ": 5.0, "idio": 2.0, "can ": 1.0})
    text = toxicity.fold(" ".join(words))
    quiet = [(m.start(), m.end()) for p in model.exceptions for m in re.finditer(rf"(?<![^\W_])(?={re.escape(p)})", text) for m in [re.compile(re.escape(p)).match(text, m.start())]]
    total = 0.0
    for entry, weight in model.weights.items():
        tail = r"(?![^\W_])" if entry.endswith(" ") else ""
        for m in re.finditer(rf"(?<![^\W_]){re.escape(entry.strip())}{tail}", text):
            if not any(a <= m.start() and m.end() <= b for a, b in quiet):
                total += weight
    got = model.features(" ".join(words), model.automaton())[0]
    assert got == pytest.approx(math.log1p(total))


def test_many_exceptions_take_linear_time():
    model = toxicity.Model(weights={"trash ": 5.0})
    began = time.monotonic()
    assert model.features("trash can " * 100_000 + "trash", model.automaton())[0] == pytest.approx(math.log1p(5.0))
    assert time.monotonic() - began < 10


def test_limits_can_be_lifted(spark):
    rows = [(i, f"plain words here {i}" + (" nastiestword" if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    free = toxicity.train(df, labels, limits=toxicity.Limits(most_entries=None, longest=None, repeats=None, top_weight=None, least_share=0.0, gain=1.0))
    assert any("nastiestword".startswith(e.strip()) for e in free.weights)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(df, free).collect()}
    assert got == {i: i % 2 for i in range(400)}


def test_longer_texts_score_lower():
    model = toxicity.Model(weights={"trash ": 5.0})
    matcher = model.automaton()
    assert model.features("trash " + "fine " * 10, matcher)[1] > model.features("trash " + "fine " * 1000, matcher)[1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    scored = toxicity.score_documents(texts, toxicity.train(texts, labels))
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").collect()
    good, bad = (np.array([r["score"] for r in rows if r["toxic"] == t]) for t in (0, 1))
    auc = (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean()
    assert auc > 0.94
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) < 0.01


def test_toxicity_without_labels_and_with_odd_rows(spark):
    df = docs(spark, ODD, score=1.0)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(df, toxicity.train(df, none)).collect()
    assert len(got) == len(ODD) and len({r["score"] for r in got}) == 1
    assert toxicity.drop_toxic(df, toxicity.Model()).columns == df.columns


# -- licenses -------------------------------------------------------------------------------


def test_licenses(spark):
    filler = "lorem ipsum dolor sit amet consectetur " * 40
    texts = [filler + "Released under the MIT License. " + filler, filler, "licensed UNDER the apache license, version 2.0", None, "", "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", "x" * 20_000, "Released under the other License."]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(docs(spark, texts, h=1, marks=2)).collect()}
    assert got == {0: "mit", 1: "", 2: "apache-2.0", 3: "", 4: "", 5: "cc-by-nc-4.0,gpl-3.0", 6: "", 7: ""}


def test_license_with_a_changed_word_is_still_held(spark):
    notice = dict(licenses.TEMPLATES)["mit-grant"]
    words = notice.split()
    changed = " ".join(["Herewith", *words[1:]])  # one of its shingles lost
    halved = " ".join(words[: len(words) // 2])
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(docs(spark, [changed, halved])).collect()}
    assert got == {0: "mit-grant", 1: ""}


def test_short_notices_are_found_inside_longer_texts(spark):
    filler = "lorem ipsum dolor sit amet consectetur " * 40
    texts = [filler + "All rights reserved. " + filler, "ALL RIGHTS, reserved", filler + "All our rights are reserved.", "rights reserved all", "All rights", "Released under the MIT License. All rights reserved.", filler + "All rights reserved"]
    got = {r["doc_id"]: (r["licenses"], r["best"]) for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    held = ("all-rights-reserved", 1.0)
    assert got == {0: held, 1: held, 2: ("", None), 3: ("", None), 4: ("", None), 5: ("all-rights-reserved,mit", 1.0), 6: held}
    own = (("one", "copyleft"), ("two", "No warranty"), ("four", "sold as it is"), ("none", "..."))
    texts = [filler + "no warranty; copyleft " + filler, filler + "is sold as it is " + filler, filler + "no such warranty"]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(docs(spark, texts), own).collect()}
    assert got == {0: "one,two", 1: "four", 2: ""}


def test_templates_as_a_table_give_the_same(spark, monkeypatch):
    filler = "lorem ipsum dolor sit amet consectetur " * 40
    whole = dict(licenses.TEMPLATES)["mit-text"]
    texts = [filler + t + " " + filler for _, t in licenses.TEMPLATES] + [None, "", "...", filler, whole.replace("sell copies", "sell some copies"), whole[: len(whole) // 2], "All rights reserved", "x " * 20_000]
    df = docs(spark, [*texts, *texts[:2]], row=1, band=2)
    want = sorted(map(str, licenses.scan_licenses(df).collect()))
    table = spark.createDataFrame([*licenses.TEMPLATES, ("none", "..."), ("null", None)], "template string, notice string")
    assert sorted(map(str, licenses.scan_licenses(df, table).collect())) == want
    monkeypatch.setattr(licenses, "MOST_TEMPLATES", 3)
    assert sorted(map(str, licenses.scan_licenses(df).collect())) == want
    assert {r["n_licenses"] for r in licenses.scan_licenses(df, table.limit(0)).collect()} == {0} == {r["n_licenses"] for r in licenses.scan_licenses(df, ()).collect()}


def plain_licenses(text):
    """Names of the templates of which some window of the text holds enough shingles, by sets of word tuples."""
    cut = lambda t: [w for w in re.sub(r"[^\w.]+|_|\.(?![0-9])", " ", t).lower().split(" ") if w]
    words, out = cut(text), set()
    for name, notice in licenses.TEMPLATES:
        own = cut(notice)
        width = min(len(own), licenses.WORDS)
        runs = lambda x: [tuple(x[i : i + width]) for i in range(len(x) - width + 1)]  # noqa: B023, E731
        mine, theirs = set(runs(own)), runs(words)
        half = 1 << (len(mine) - 1).bit_length()
        for at in range(0, max(1, len(theirs)), half):
            if len(mine & set(theirs[at : at + 2 * half])) >= math.ceil(licenses.CONTAINMENT * len(mine) - 1e-9):
                out.add(name)
    return ",".join(sorted(out))


def test_licenses_agree_with_plain_containment(spark, sf):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for i, (_, notice) in enumerate(licenses.TEMPLATES):
        words = notice.split()
        rows[-1 - i] = "some words before " + " ".join(words[: max(3, int(len(words) * 0.9))]) + " and after"
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(df).collect()}
    assert got == {i: plain_licenses(t) for i, t in rows.items()}


def test_band_settings():
    assert licenses.band_probability(0.2) > 0.9999


# -- shingles and pieces --------------------------------------------------------------------


def plain_shingles(text):
    words = [w.decode("utf-8") for w in (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()]
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@settings(max_examples=60, deadline=None)
@given(st.text("aAb \tÀ\n\x0b", max_size=60), st.text("aAb \tÀ\n\x0b", max_size=60))
def test_shingle_sets(a, b):
    shingle_set = Shingler(b"key")
    x, y = plain_shingles(a), plain_shingles(b)
    if not (a or "").split():
        x = x & set()
    assert len(shingle_set(a)) == len(x)
    assert overlap(shingle_set(a), shingle_set(b)) == len(plain_shingles(a) & y) or not len(x)


def test_minhash_estimates_similarity():
    a, b = np.arange(1, 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(101, 1101, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sign = MinHash(512)
    assert abs((sign(a) == sign(b)).mean() - 900 / 1100) < 0.08


def test_pieces_agree_with_the_library_and_round_trip(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t or "" for t in ODD] + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ["a" + " " * 37 + "b", "  \n  ", "\U0001f600", "ab" * 400]
    ids, offsets = encoder().encode(texts)
    for i, want in enumerate(library.encode(texts)):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want, texts[i][:50]
    assert [t.decode() for t in encoder().decode(ids, offsets)] == texts


@pytest.mark.parametrize("text", ["ab" * 60_000, "日本語の文章は空白がないので" * 9_000, "abc" * 40_000 + " x", "x" * 120_000])
def test_long_words_agree_with_the_library(text):
    import sentencepiece

    began = time.monotonic()
    ids, offsets = encoder().encode([text])
    assert time.monotonic() - began < 15
    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text)


def test_pieces_of_any_length():
    words = ["▁" + "ab" * n for n in (1, 2, 4, 8, 16, 32, 64)]
    pieces = ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "b", "ab", *["ab" * n for n in (2, 4, 8, 16, 32, 64)], *words]
    coder = Encoder(Vocabulary(pieces, [-float(i) for i in range(len(pieces))], [i > 256 for i in range(len(pieces))], 1))
    ids, _ = coder.encode(["ab" * 64])
    assert coder.depth >= 129 and [pieces[i] for i in ids] == ["▁" + "ab" * 64]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("theTHE ing\n.é😀0", max_size=40), min_size=1, max_size=6))
def test_random_pieces_agree_with_the_library(texts):
    import sentencepiece

    ids, offsets = encoder().encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts)


def test_encoded_documents_decode(spark):
    df = docs(spark, [*ODD, "▁ sign"], ids="x")
    coded = encode_documents(df)
    back = {r["doc_id"]: r["text"] for r in decode_documents(coded).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))
    assert {r["doc_id"]: r["round_trip"] for r in coded.collect()}[len(ODD)] is False
    assert encode_documents(df.limit(0)).count() == 0
