import random
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import DOCS, docs, no_docs, ordered, rows
from oracle_check import compare, duck

from tarmac.llm import license, mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module", [quality, license, mixing], ids=lambda m: m.__name__)
def test_equals_sql(spark, module):
    found = compare(module.query(spark, SF), duck(SF), module.ORACLE)
    assert found["values_match"] and found["spark_rows"] > 0, found


def plain_measure(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {p for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")) if w else 0,
            len(lines) - len(set(lines)), len(covered), len(lines))


def test_measures_equal_plain_version():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "c\n", "|", "é𝒳"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    for t in [*texts, *(d[1] for d in DOCS)]:
        assert quality.measure(t) == plain_measure(t)


def test_quality_odd_rows(spark):
    got = quality.judged(docs(spark)).collect()
    assert len(got) == len(DOCS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(by[1]) == 2 and by[1][0] == by[1][1]
    assert by[3][0].n_words == 0 and by[3][0].base_failed and not by[3][0].kept
    assert quality.judged(no_docs(spark)).count() == 0


def test_bad_host_goes_and_small_host_is_shrunk(spark):
    good, bad = " ".join(f"plain{i}" for i in range(60)), "short text"
    data = [(i, good, "good") for i in range(60)] + [(100 + i, bad, "bad") for i in range(60)]
    data += [(500, good, "bad"), (600, bad, "tiny"), (601, good, "tiny")]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and not got[500].kept and not got[500].host_kept and not got[500].base_failed
    assert got[601].host_kept == got[600].host_kept


def test_prior_weight():
    # All hosts alike: nothing beyond chance, the strongest prior.
    assert quality.prior_weight(0.5, 10 * 5 * 5 / 10, 100, 10 * 100, 10) == quality.PRIOR_MAX
    # Hosts all good or all bad: the weakest.
    assert quality.prior_weight(0.5, 5 * 100 * 100 / 100, 1000, 10 * 100 * 100, 10) == quality.PRIOR_MIN
    assert quality.prior_weight(0.0, 0.0, 0, 0, 0) == quality.PRIOR_MAX


def plain_dice(a, b):
    wa, wb = (re.sub(r"[^\w]+|_", " ", x.lower()).split() for x in (a, b))
    ca, cb = Counter(zip(wa, wa[1:])), Counter(zip(wb, wb[1:]))
    return 2 * sum((ca & cb).values()) / max(1, sum(ca.values()) + sum(cb.values()))


def test_signals_prune_nothing():
    rng = random.Random(2)
    texts = [t for _, t in license.TEMPLATES]
    words = set(license.signals(texts))
    for _ in range(3000):
        t = rng.choice(texts)
        w = re.findall(r"[a-z0-9]+", t.lower())
        cut = [x for x in w if rng.random() < 0.9 and x not in words]
        assert all(plain_dice(" ".join(cut), x) < 0.85 for x in texts)


def test_license_odd_rows_and_edits(spark):
    apache = license.TEMPLATES[1][1]
    data = [(1, "Intro\n" + apache.replace("obtain", "get") + "\nprose"), (2, "RELEASED under the  MIT-License!"),
            (3, None), (4, ""), (5, "a licensed plumber works under the sink without a license"),
            (6, "text. Licensed under CC BY-NC 4.0."), (6, "text. Licensed under CC BY-NC 4.0."),
            (None, "Released under the MIT License."), (7, apache.replace("\n", "\n\n", 1))]
    got = ordered((r.doc_id, r.license, r.n_units) for r in license.license_matches(
        spark.createDataFrame(data, "doc_id long, text string")).collect())
    assert (1, "Apache-2.0", 1) in got and (2, "MIT", 1) in got and (None, "MIT", 1) in got
    assert (6, "CC-BY-NC-4.0", 2) in got  # the sentence, and the line it ends
    assert not [g for g in got if g[0] in (3, 4, 5)]
    assert license.license_matches(docs(spark)).count() == 0
    assert license.license_matches(no_docs(spark)).count() == 0


def test_mixing_odd_rows(spark):
    got = mixing.mixed(docs(spark), block=16).collect()
    assert len(got) == len(DOCS)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in DOCS}
    for r in got:
        assert r.taken <= 3 * r.size and (r.doc_id is None or r.size == size[r.doc_id])
        assert (r.first_slot is None) == (r.n_slots == 0) == (r.taken == 0)
    by = defaultdict(list)
    for r in got:
        by[r.source_size, r.target].append(r.taken)
    assert abs(sum(r.size for r in got) - sum(t for _, t in by)) < 1e-6
    assert all(sum(v) == int(t) for (_, t), v in by.items())
    assert ordered(map(tuple, got)) == ordered(map(tuple, mixing.mixed(docs(spark), block=16).collect()))
    assert mixing.mixed(no_docs(spark)).count() == 0


def test_schedule_is_even_and_whole(spark):
    targets = spark.createDataFrame([(0, 1000, 3000.0), (1, 9000, 5000.0), (2, 40, 120.0), (3, 0, 0.0)],
                                    "rank long, source_size long, target double")
    got = sorted(mixing.schedule(targets, block=16).collect())
    per = defaultdict(list)
    for r in got:
        per[r["rank"]].append(r)
    assert [len(per[k]) for k in range(3)] == [189, 313, 9]
    assert all(sorted(x.nth for x in v) == list(range(len(v))) for v in per.values())
    # Every source stays within a few slots of its share in every prefix of the schedule.
    for k, slots in ((0, 189), (1, 313), (2, 9)):
        done = 0
        for n, r in enumerate(got, 1):
            done += r["rank"] == k
            assert abs(done - n * slots / 511) < 4, (k, n, done)
    assert len(rows(mixing.schedule(targets.limit(0)))) == 0


def test_license_notices_of_several_paragraphs(spark):
    gpl, apache = license.TEMPLATES[12][1], license.TEMPLATES[1][1]
    prose = " ".join(f"plain{k}" for k in range(45))
    paragraphs = lambda t: re.sub(r"\.\s+", ".\n\n", t)
    one_line = lambda t: " ".join(t.split())
    mit = license.TEMPLATES[17][1]
    data = [(1, f"Copyright A\n\n{paragraphs(one_line(gpl))}\n\n{prose}"), (2, f"{prose}. {one_line(gpl)} {prose}."),
            (3, paragraphs(one_line(apache).replace('"License"); you', '"License");\n\nyou'))),
            (None, f"{prose}.\n\n{paragraphs(one_line(gpl))}"), (4, paragraphs(one_line(gpl))[:150] + prose),
            (5, f"{prose}.\n\n" + paragraphs(one_line(gpl)) + "\n\n" + mit.replace("conditions:", "conditions:\n\n")),
            (6, "This work is licensed under the GNU\n\nGeneral Public License,\nversion 3.")]
    got = {(r.doc_id, r.license): (r.n_units, round(r.best_dice, 2)) for r in license.license_matches(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1, "GPL-3.0"] == got[2, "GPL-3.0"] == got[None, "GPL-3.0"] == (1, 1.0)
    assert got[3, "Apache-2.0"][1] > 0.85
    assert got[5, "GPL-3.0"] == got[6, "GPL-3.0"] == (1, 1.0)
    assert got[5, "MIT"] == (1, 0.87)  # its first paragraph alone is a unit that states it
    assert set(got) == {(1, "GPL-3.0"), (2, "GPL-3.0"), (3, "Apache-2.0"), (None, "GPL-3.0"), (5, "GPL-3.0"),
                        (5, "MIT"), (6, "GPL-3.0")}
