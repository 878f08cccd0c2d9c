import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_cases import DOCS, docs, no_docs

from tarmac.llm import bilstm, langid, pii
from tarmac.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_phrases(sample, text):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and tuple(text[at:at + size + 1]) in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_parse_takes_longest_matches():
    rng = random.Random(1)
    model = langid.learn({"x": ["abracadabra " * 3, "banana"], "y": ["the cat sat on the mat"]})
    for k, raw in enumerate((["abracadabra " * 3, "banana"], ["the cat sat on the mat"])):
        s = langid.fold(model.symbol, raw)[0].tolist()
        subs = {tuple(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for _ in range(60):
            text = "".join(rng.choice("abcdnrht zé ") for _ in range(rng.randrange(1, 200)))
            t = langid.fold(model.symbol, [text])[0].tolist()
            counts, size = langid.phrases(model, [text])
            if size[0]:
                assert counts[k][0] == plain_phrases(subs, t)


def test_pieces_cover_long_texts():
    model = langid.learn({"x": ["hello world again"], "y": ["bonjour le monde"]})
    short, size = langid.phrases(model, ["hello world " * 10])
    both, sizes = langid.phrases(model, ["hello world " * 4000, "hello world " * 10, "", "123"])
    assert both[0][1] == short[0][0] and sizes.tolist()[1:] == [size[0], 0, 0]
    assert sizes[0] > 40_000 and both[0][0] < both[1][0]


def test_phrases_run_across_pieces(monkeypatch):
    rng = random.Random(4)
    samples = {"x": ["abab" * 9, "aaaaaaab"], "y": ["cabbage " * 5], "z": ["b"]}
    model = langid.learn(samples)
    subs = []
    for raw in samples.values():
        s = langid.fold(model.symbol, raw)[0].tolist()
        subs.append({tuple(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)})
    texts = ["a" * 500, "ab" * 300, "cabbage " * 60, "", "7", "b"]
    texts += ["".join(rng.choice("aab cge?") for _ in range(rng.randrange(200))) for _ in range(60)]
    folded = [langid.fold(model.symbol, [t])[0].tolist() for t in texts]
    expected = [[plain_phrases(sample, f) if any(f) else 0 for f in folded] for sample in subs]
    for piece, lanes, together in ((128, 1 << 20, 3), (5, 1 << 20, 3), (5, 35, 1), (1, 4, 0), (7, 7, 2)):
        monkeypatch.setattr(langid, "PIECE", piece)
        monkeypatch.setattr(langid, "LANES", lanes)
        monkeypatch.setattr(langid, "TOGETHER", together)
        assert langid.phrases(model, texts)[0].tolist() == expected


def test_scripts_of_many_letters(spark):
    """Two languages that share a script of 3,000 letters and differ in their words only."""
    rng = random.Random(6)
    words = {k: ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2)) for _ in range(1500)] for k in "ab"}
    rows = [(i, "".join(rng.choice(words["ab"[i % 2]]) for _ in range(60)), "ab"[i % 2]) for i in range(300)]
    found = langid.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    label = {i: lang for i, _, lang in rows}
    held = [r for r in found if r.held_out]
    assert len(held) > 40 and sum(r.lang_pred == label[r.doc_id] for r in held) >= 0.97 * len(held)
    model = langid.learn({k: ["".join(w)] for k, w in words.items()})
    assert len(model.symbol[0x4E00:0x4E00 + 3000]) == 3000 and model.symbol.max() > 2000


def test_training_reads_from_hashed_places(spark):
    """What identifies the language stands in the last part of long texts only."""
    rows = [(i, "x " * 300 + ("alpha beta " if i % 2 else "gamma delta ") * 200, "ab"[i % 2]) for i in range(200)]
    found = langid.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == "ab"[r.doc_id % 2] for r in found if r.held_out)


def test_held_out_accuracy_and_contract(spark):
    got = {r.doc_id: r for r in langid.query(spark, SF).collect()}
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"])
    label = dict(zip(*[c.to_pylist() for c in t]))
    held = [i for i in label if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == label[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_langid_odd_rows(spark):
    got = [(r.doc_id, r.lang_pred) for r in langid.identified(docs(spark)).collect()]
    assert len(got) == len(DOCS)
    found = dict(got)
    assert found[3] == found[4] == found[5] == "und" and found[1] == "en"
    assert langid.identified(no_docs(spark)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.identified(unlabelled).collect()] == [(1, False, "und", 0.0)]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    bits = ["a", "Z9", "@", ".", "@b.co", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "+1 (017) 555-7713", " ",
            "-", "%", "é", "𝒳", "0", "\n", "@@", "x@y", "10.0.0.1.5"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == plain_base(text), text
    bits = ["0", "1", "25", "255", "256", ".", "..", "000", " ", "x"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(20)))
        assert pii.base_spans(text) == plain_base(text), text
    for long in ("a" * 300_000 + "@" + "1" * 3000, "1" * 1_000_000, "1.1" * 300_000, ("9" * 50_000 + ".") * 20):
        pii.base_spans(long)  # long runs are read once


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(table(spark, SF, "documents"))


def test_contract_columns(spark, tagger):
    d = table(spark, SF, "documents").limit(400)
    for r in pii.with_spans(d, tagger, "f").select("text", "f.*").collect():
        base = plain_base(r.text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert set(joined.split(",")) - {""} <= set(spans) and len(spans) == len(base) + r.n_added


def test_tagger_finds_other_writings(tagger):
    rng = np.random.default_rng(5)
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    tried = found = 0
    for text in texts:
        for kind, a, b in pii.base_spans(text)[:1]:
            new = pii.rewritten(kind, text[a:b], rng)
            if pii.sound(kind, new) and len(new) < 48:
                tried += 1
                got = pii.all_spans(tagger, [text[:a] + new + text[b:]])[0][1]
                found += any(s[0] == kind and s[1] < a + len(new) and a < s[2] for s in got)
        if tried >= 150:
            break
    assert found >= 0.8 * tried


AT = (" [at] ", "[at]", " (at) ", "(at)", " @ ", "@")
DOT = ("[.]", " [dot] ", "(dot)", ".")
NAMES = ("anna.meier@firma.de", "tom@mail.example.com", "lena.graf@post.example.org", "info@verein.net",
         "paul-otto@shop.example.com", "die.erste@mail.example.com")


def test_emails_without_digits_in_other_writings(tagger):
    tried = found = 0
    for at in AT:
        for dot in DOT:
            for name in NAMES:
                value = name.replace("@", at).replace(".", dot)
                assert pii.sound("email", value)
                text = f"If you have any questions, write to {value} before the end of the week"
                assert pii.window_starts(text)
                spans = pii.all_spans(tagger, [text])[0][1]
                tried += 1
                found += ("email", 36, 36 + len(value)) in spans
    print("digitless", tried, found)
    assert found >= 0.8 * tried


def test_base_spans_keep_their_place():
    rng = random.Random(7)
    for _ in range(500):
        base = sorted((a, a + rng.randrange(1, 9)) for a in (rng.randrange(40) for _ in range(rng.randrange(5))))
        starts, reach = [s for s, _ in base], list(itertools.accumulate((e for _, e in base), max))
        a = rng.randrange(40)
        b = a + rng.randrange(1, 9)
        assert pii._clear(starts, reach, a, b) == all(b <= s or e <= a for s, e in base)


def test_email_without_digits_or_at_sign_is_redacted(spark, tagger):
    text = "Please write to anna.meier [at] firma [dot] de for the forms"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in pii.redacted(one, tagger).collect()] == ["Please write to [EMAIL] for the forms"]
    assert [r.f.n_added for r in pii.with_spans(one, tagger, "f").collect()] == [1]


def test_clean_numbers_are_left_alone(tagger):
    clean = ["Version 2.0 of 3.1.4", "in 1999, 2001 and 2024-01-15 at 10:30", "ISBN 978-3-16", "pages 100-120 of 4000",
             "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "12 500 000 people", "id 9807915762804491"]
    assert all(not spans for _, spans in pii.all_spans(tagger, clean))


def test_windows_reconcile_over_long_texts(tagger):
    # No base pattern matches: phone and card run together, and matches are not retried.
    unit = "erha onheat +1 (636) 555-9305 4078918989542222 the thonre ing hanent. "
    base, spans = pii.all_spans(tagger, [unit * 40])[0]
    assert not base and len(spans) >= 20
    values = {(kind, (unit * 40)[a:b]) for kind, a, b in spans}
    assert values <= {("card", "4078918989542222"), ("phone", "+1 (636) 555-9305")}


def test_gradients():
    rng = np.random.default_rng(0)
    vocab, hidden, tags = 7, 4, 5
    allowed, start = np.ones((tags, tags), bool), np.array([1, 1, 0, 1, 0], bool)
    allowed[0, 2] = False
    x = rng.integers(0, vocab, (6, 3))
    y = np.array([[0, 1, 3], [1, 2, 0], [2, 2, 1], [0, 0, 2], [3, 1, 2], [3, 4, 0]])
    shapes = {"table_f": (vocab, 4 * hidden), "table_b": (vocab, 4 * hidden), "rec_f": (hidden, 4 * hidden),
              "rec_b": (hidden, 4 * hidden), "out": (2 * hidden, tags), "bias": (tags,), "trans": (tags, tags)}
    p = {k: rng.normal(0, .3, s).astype(np.float32) for k, s in shapes.items()}

    def loss(p):
        return bilstm._crf_gradient(bilstm.emissions(p, x)[0], *bilstm._scores(p, allowed, start), y)

    _, d_e, d_trans = loss(p)
    _, both, (_, cf), (_, cb) = bilstm.emissions(p, x)
    d_both = d_e @ p["out"].T
    g = {"trans": np.where(allowed, d_trans, 0), "bias": d_e.sum(axis=(0, 1)),
         "out": both.reshape(-1, 2 * hidden).T @ d_e.reshape(-1, tags)}
    g["table_f"], g["rec_f"] = bilstm._lstm_back(x, p["rec_f"], cf, d_both[:, :, :hidden], vocab)
    g["table_b"], g["rec_b"] = bilstm._lstm_back(x[::-1], p["rec_b"], cb, d_both[::-1, :, hidden:], vocab)
    for k in p:
        at = (1, 1) if k == "trans" else tuple(rng.integers(0, n) for n in p[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert abs((loss(up)[0] - loss(down)[0]) / 2e-2 - g[k][at]) < 1e-3


def test_pii_odd_rows(spark):
    got = pii.personal_data(docs(spark))
    found = got.collect()
    assert len(found) == len(DOCS) and all(r.spans == "" for r in found)
    assert found[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(no_docs(spark)).count() == 0
    text = "Mail a.b@c.org or +1 (017) 555-7713; card 4111 1111 1111 1111."
    one = spark.createDataFrame([(1, text, 3), (2, None, 3), (3, "", 3)], "doc_id long, text string, spans int")
    left = pii.redacted(one, None)
    assert left.columns == one.columns
    assert sorted(map(tuple, left.collect())) == [
        (1, "Mail [EMAIL] or [PHONE]; card [CARD].", 3), (2, None, 3), (3, "", 3)]
