"""Near duplicates, passages, top-k, language and quality."""

import random

import numpy as np
import pytest
import xxhash
from matchloom.llm import balltree, chains, dsir, langid, simhash
from matchloom.llm.common import Scratch
from matchloom.llm.components import components
from pyspark.sql import functions as F

from .conftest import DOCS, ODD, prose

crowded = chains._crowded


def _brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    own = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_groups(prints):
    ids, group = sorted(prints), {}
    for start in ids:
        if start in group:
            continue
        reach = [start]
        group[start] = start
        while reach:
            i = reach.pop()
            for j in ids:
                if j not in group and (prints[i] ^ prints[j]).bit_count() <= 3:
                    group[j] = start
                    reach.append(j)
    return group


def test_simhash(spark, odd, none):
    rows, rnd = [], random.Random(2)
    for i in range(120):
        words = prose(i % 40, 400)
        for _ in range(rnd.randint(0, 3) if i >= 40 else 0):
            words[rnd.randrange(400)] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(r[0], r[1]) for r in ODD if r[0] is not None and r[0] not in range(120)] + [(500, None), (501, "")]
    prints = {i: _brute_fingerprint(t) for i, t in rows}
    group = _brute_groups(prints)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == group and len(set(group.values())) < len(group)
    assert simhash.near_duplicates(odd).count() == len(ODD) and simhash.near_duplicates(none).count() == 0


def test_cells_lose_no_link(spark, monkeypatch):
    rnd, prints = random.Random(4), set()
    for _ in range(60):
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice((1, 1, 2, 6, 40))):
            prints.add(x)
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
    group = _brute_groups({p: p for p in prints})
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for tile in (16384, 8):
        monkeypatch.setattr(simhash, "TILE", tile)
        root = {r.node: r.root for r in components(simhash.links(df), Scratch(spark, "test")).collect()}
        same = {}
        for p in prints:
            same.setdefault(root.get(signed(p), signed(p)), set()).add(group[p])
        assert all(len(g) == 1 for g in same.values()) and len(same) == len(set(group.values()))


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(9), Scratch(spark, "test")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(200))
    assert all(got[a] == got[b] <= min(a, b) for a, b in edges if a != b)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_passages(spark, odd, none):
    rnd, shared = random.Random(6), prose(900, 80)
    rows, places = [], {}
    for i in range(60):
        words = prose(i, 300)
        if i % 5 == 0:  # the passage, fuzzy in half of the documents
            own = list(shared)
            if i % 10 == 0:
                for _ in range(5):
                    own[rnd.randrange(80)] = "edited"
                del own[40]
            at = rnd.randrange(300)
            words[at:at] = own
            places[i] = (at, at + len(own))
        if i % 7 == 3:
            words += ["one", "short", "shared", "line", "of", "words"]
        rows.append((i, " ".join(words), "en", "a", 0))
    docs = spark.createDataFrame(rows, DOCS)
    got = chains.shared_passages(docs).collect()
    assert {r.doc_id for r in got} == set(places)
    for r in got:
        a, b = places[r.doc_id]
        assert r.other_id in places and r.other_id != r.doc_id and r.identity >= 0.8
        assert a - 3 <= r.start_word <= a + 20 and b - 20 <= r.end_word <= b + 3 and (r.class_id, r.class_docs) == (0, len(places))
    cut = {r.doc_id: r for r in chains.without_repeats(docs, n_chars_col="n_chars").collect()}
    for i, text, *_ in rows:
        assert cut[i].n_chars == len(cut[i].text)
        assert (cut[i].text == text) == (i not in places or i == 0)
    assert chains.shared_passages(none).count() == 0 and chains.without_repeats(odd).count() == len(ODD)
    assert all(r.doc_id is not None for r in chains.shared_passages(odd).collect())


def test_passage_in_the_gap_of_another_chain(spark):
    head, middle, foot, moved = prose(901, 100), prose(902, 70), prose(903, 100), prose(904, 70)
    rows = [(1, head + prose(1, 200) + foot + moved), (2, prose(2, 90) + middle + prose(3, 90)), (3, head + prose(4, 30) + middle + prose(5, 20) + moved + prose(6, 10) + foot)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = [r for r in chains.shared_passages(docs).collect() if r.doc_id == 3]
    for other, start, end in ((1, 0, 100), (2, 130, 200), (1, 220, 290), (1, 300, 400)):
        assert any(r.other_id == other and abs(r.start_word - start) <= 3 and abs(r.end_word - end) <= 3 for r in got)
    assert chains.without_repeats(docs).where("doc_id = 3").first().text.split() == rows[2][1][100:130] + rows[2][1][200:220] + rows[2][1][290:300]


def test_run_whose_parts_others_have(spark):
    rows = []
    for g in range(0, 8000, 1000):
        whole = prose(910 + g, 60)
        for i, part in ((1, whole[:30]), (2, whole[30:]), (100, whole), (200, whole), (901, whole[:30]), (902, whole[30:])):
            rows.append((g + i, prose(g + i, 40) + part + prose(g + i + 500, 40)))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {(r.doc_id, r.other_id): r for r in chains.shared_passages(docs).collect()}
    assert set(got) == {(g + a, g + b) for g in range(0, 8000, 1000) for a, b in ((100, 200), (200, 100))}
    assert all(abs(r.start_word - 40) <= 3 and abs(r.end_word - 100) <= 3 for r in got.values())


def test_runs_of_fifty_against_brute_force(spark):
    """Documents made of pieces that others have too: those with a run of 50 equal words in common are in one class."""
    rnd, rows = random.Random(12), []
    pieces = [prose(2000 + k, n) for k, n in enumerate([10, 20, 30, 49, 50, 51, 60, 75, 120, 25, 25, 35])]
    for i in range(150):
        words = []
        for _ in range(rnd.randint(1, 6)):
            words += rnd.choice(pieces) if rnd.random() < 0.6 else prose(5000 + rnd.randrange(10**6), rnd.randint(1, 40))
        rows.append((i, " ".join(words)))
    runs = {}
    for i, text in rows:
        words = text.split()
        for k in range(len(words) - 49):
            runs.setdefault(" ".join(words[k : k + 50]), set()).add((i, k))
    got, classes = chains.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), {}
    for r in got:
        classes.setdefault((r.class_id, r.class_start), set()).add((r.doc_id, r.start_word, r.end_word))
        assert r.doc_id != r.other_id and r.identity >= 0.8 and r.end_word - r.start_word >= 50
    for places in runs.values():
        if len({i for i, _ in places}) > 1:
            assert any(all(any(d == i and a <= k + 10 and b >= k + 40 for d, a, b in own) for i, k in places) for own in classes.values())
    assert all(r.class_docs == len({d for d, *_ in classes[r.class_id, r.class_start]}) for r in got)


def test_copies_are_one_class(spark):
    shared = prose(900, 80)
    rows = [(i, " ".join(prose(i, 100) + shared + prose(100 + i, 100))) for i in range(30)]
    got = chains.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id, r.class_docs) for r in got} == {(i, 0, 30) for i in range(30)}
    assert len({(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in got}) < 8 * 30


@pytest.mark.parametrize("edits", [0.05, 0.1, 0.15, 0.2])
def test_recall_of_edited_passages(spark, edits):
    """Passages of 200 words in an original and a copy with so many words replaced."""
    rnd, rows, n = random.Random(int(100 * edits)), [], 60
    for g in range(n):
        own = prose(3000 + g, 200)
        other = list(own)
        for k in rnd.sample(range(200), int(200 * edits)):
            other[k] = f"edit{rnd.randrange(10**6)}"
        rows += [(2 * g, " ".join(prose(g, 50) + own + prose(g + 500, 50))), (2 * g + 1, " ".join(prose(g + 1000, 50) + other + prose(g + 1500, 50)))]
    covered = {}
    for r in chains.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.doc_id // 2 == r.other_id // 2
        covered.setdefault(r.doc_id, set()).update(range(max(r.start_word, 50), min(r.end_word, 250)))
    assert sum(map(len, covered.values())) >= 0.9 * 200 * 2 * n


def test_best_stretches_against_brute_force():
    rnd = np.random.default_rng(6)
    for _ in range(150):
        n = int(rnd.integers(0, 90))
        kind = rnd.random(n)
        share = rnd.uniform(0.6, 1)
        columns = np.stack((kind > 0.03, kind < 0.97, rnd.random(n) < share), 1)
        columns[:, 2] &= columns[:, 0] & columns[:, 1]
        score = np.where(columns[:, 2], 1, -chains.PENALTY)
        best = max((int(columns[s:e, 0].sum()) for s in range(n) for e in range(s + 2, n + 1) if score[s:e].sum() >= 0 and columns[s : s + 2, 2].all() and columns[e - 2 : e, 2].all()), default=0)
        pad = np.zeros((7, 3), bool)
        who, start, end = chains.stretches(np.concatenate((pad, columns, pad)), np.array([0, 7, 7 + n]), np.array([7, 7 + n, 14 + n]), 20)
        assert set(who.tolist()) <= {1} and bool(len(who)) == (best >= 20)
        if len(who):
            assert columns[start[0] - 7 : end[0] - 7, 0].sum() == best and all(score[a - 7 : b - 7].sum() >= 0 for a, b in zip(start, end))
            spans = sorted(zip(start.tolist(), end.tolist()))
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_edit_path_has_fewest_edits():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        x, y = (rnd.integers(0, 4, int(rnd.integers(0, 9))).astype(np.int32) for _ in range(2))
        found = chains._edit_path(x, y)
        table = {(i, j): i + j for i in range(len(x) + 1) for j in range(len(y) + 1) if not i * j}
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (x[i - 1] != y[j - 1]))
        assert (~found[:, 2]).sum() == table[len(x), len(y)] and found[:, 0].sum() == len(x) and found[:, 1].sum() == len(y)


def test_cutting_goes_by_what_stays(spark):
    first = prose(950, 200)
    second = [f"second{k}" if k % 8 == 3 else w for k, w in enumerate(first)]
    third = [f"third{k}" if k % 8 == 7 else w for k, w in enumerate(second)]  # 7 of 8 words as in the second, 3 of 4 as in the first
    docs = spark.createDataFrame([(i, " ".join(w), "clash", 7) for i, w in enumerate((first, second, third))], "doc_id long, text string, cut_spans string, c0 int")
    got = {r.doc_id: r for r in chains.without_repeats(docs).collect()}
    assert got[0].text.split() == first and {r.cut_spans for r in got.values()} == {"clash"}
    assert len(got[1].text.split()) < 20 and got[2].text.split() == third
    again = spark.createDataFrame([(1, " ".join(first)), (1, " ".join(first)), (1, " ".join(prose(952, 30) + first)), (2, None), (None, " ".join(first)), (3, "")], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.text) for r in chains.without_repeats(again).collect()), key=str)
    assert len(rows) == 6 and (None, " ".join(first)) in rows and (2, None) in rows and (3, "") in rows
    assert sum(" ".join(first) in (t or "") for i, t in rows if i == 1) in (1, 2)


def test_passages_with_crowded_seeds_only(spark):
    """Two late texts share a passage whose only equal 5-mers are those of a line that many unlike texts have."""
    line, body = prose(70, 14), prose(71, 45)
    edited = [w if i % 5 != 2 else f"other{i}" for i, w in enumerate(body)]
    rows = [(i, " ".join([*prose(100 + i, 60), *line, *prose(200 + i, 60)])) for i in range(30)]
    rows += [(50, " ".join([*prose(72, 30), *line, *body, *prose(73, 30)])), (51, " ".join([*prose(74, 30), *line, *edited, *prose(75, 30)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.other_id): r for r in chains.shared_passages(docs).collect()}
    assert set(got) == {(50, 51), (51, 50)} and got[51, 50].class_id == 50 and got[51, 50].class_docs == 2
    assert chains.without_repeats(docs).where("doc_id = 51").first().text.split() != rows[-1][1].split()


def test_near_copies_stay_in_one_class(spark, monkeypatch):
    """Links of many near copies go to the first ones, and all of them are in the class that links between all pairs make."""
    rnd, base = random.Random(6), prose(76, 120)
    rows = [(i, " ".join(w if rnd.random() > 0.07 else prose(1000 * i + j, 1)[0] for j, w in enumerate(base))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, links = [], []
    for every in (True, False):
        monkeypatch.setattr(chains, "_crowded", lambda least, _, make=crowded, every=every: make(least, every))
        got = chains.shared_passages(docs).collect()
        sizes.append({(r.doc_id, r.class_id, r.class_docs) for r in got})
        links.append(len({(r.doc_id, r.other_id) for r in got}))
    assert {(c, n) for _, c, n in sizes[1]} == {(0, 60)} == {(c, n) for _, c, n in sizes[0]} and len({d for d, _, _ in sizes[1]}) == 60
    assert links[1] < links[0] / 2


def test_near_copies_are_cut_by_few_links(spark):
    """Of near copies the pipeline's way of finding passages makes links with the first ones, not between all; all but one copy go."""
    rnd, base = random.Random(7), prose(77, 120)
    rows = [(i, " ".join(w if rnd.random() > 0.05 else prose(2000 * i + j, 1)[0] for j, w in enumerate(base))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = chains.find_passages(docs, chains.Scratch(spark, "few"), "text", "doc_id", chains.LEAST, runs=True)
    assert len({(r.doc, r.other) for r in links.collect()}) < 60 * 59 / 4
    left = {r.doc_id: len(r.text.split()) for r in chains.without_repeats(docs).collect()}
    assert left[0] == 120 and max(n for i, n in left.items() if i) < 40


def test_copies_of_what_went_are_cut(spark):
    """The second text goes for its likeness to the first. Many texts are like the second only, and one another: one of them stays."""
    first = prose(78, 160)
    second = [f"two{k}" if k % 8 == 3 else w for k, w in enumerate(first)]
    rows = [(0, first), (1, second)]
    for i in range(2, 22):
        rows.append((i, [f"own{i}x{k}" if k % 24 == i % 7 + 8 else f"third{k}" if k % 8 == 7 else w for k, w in enumerate(second)]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    left = {r.doc_id: len(r.text.split()) for r in chains.without_repeats(docs).collect()}
    assert left[0] == left[2] == 160 and max(n for i, n in left.items() if i not in (0, 2)) < 50


def test_gaps_around_a_seed():
    """The balance of words on one side of a seed against alignments tried one by one."""
    rnd = random.Random(9)
    for _ in range(60):
        x = [rnd.randint(2, 9) for _ in range(chains.NEAR)]
        y = [w for w in x if rnd.random() > 0.06][: rnd.randint(20, 64)]
        y = [rnd.randint(2, 9) if rnd.random() < 0.08 else w for w in y]
        want = [0] + [None] * chains.NEAR
        top = {(0, 0, chains.K, True): 0}  # by words taken, equal ones at the end, whether the diagonal has had a run
        for i in range(chains.NEAR + 1):
            for j in range(len(y) + 1):
                for end in range(chains.K + 1):
                    for seeded in (False, True):
                        if (value := top.get((i, j, end, seeded))) is None or abs(j - i) > chains.BAND:
                            continue
                        moves = [(i + 1, j, 0, False, -chains.PENALTY), (i, j + 1, 0, False, -chains.PENALTY)]
                        if i < chains.NEAR and j < len(y):
                            n = min(end + 1, chains.K) if x[i] == y[j] else 0
                            moves.append((i + 1, j + 1, n, seeded or (n == chains.K and end < chains.K), 1 if x[i] == y[j] else -chains.PENALTY))
                        for a, b, n, held, gain in moves:
                            if a <= chains.NEAR and b <= len(y) and abs(b - a) <= chains.BAND:
                                top[a, b, n, held] = max(top.get((a, b, n, held), -9999), value + gain)
        for (i, j, end, seeded), value in top.items():
            if i and seeded and end >= 2:
                want[i] = max(want[i] if want[i] is not None else -9999, value)
        words = [np.array([[*t, *[0] * (chains.NEAR - len(t))]], np.uint16) for t in (x, y)]
        got = chains.balances(*words, chains.K)[:, 0]
        for i in range(chains.NEAR):
            assert want[i] is None and got[i] < -5000 or want[i] == got[i] or abs(want[i]) > 200


def test_crowded_seeds_keep_what_alignment_finds():
    """Around a seed no pair is left out whose words, with gaps, have a passage of 50 to 99 columns that holds the seed."""
    rnd, needs = random.Random(5), chains.least_equal()
    for _ in range(300):
        n, at = rnd.randint(50, 99), rnd.randint(0, 45)
        columns = ["="] * n
        for i in rnd.sample([i for i in range(n) if not at <= i < at + chains.K], min(n - chains.K, n // 5)):
            columns[i] = rnd.choice("x-+")
        sides = []
        for part in (columns[:at][::-1], columns[at + chains.K :]):
            words = [rnd.randint(1, 40) for _ in part]
            x = [w for w, c in zip(words, part) if c != "+"]
            y = [w if c == "=" else 50 + w for w, c in zip(words, part) if c != "-"]
            sides.append([np.array((t + [0] * chains.NEAR)[: chains.NEAR], np.uint16) for t in (x, y)])
        x, y = (np.concatenate([s[k] for s in sides])[None] for k in (0, 1))
        assert chains.may_share(x, y, needs)[0, 0]


def test_passages_with_one_seed_in_common(spark):
    rows = []
    for g in range(0, 80, 2):  # words 24 to 35 are equal, of the others every sixth isn't
        own = prose(920 + g, 60)
        other = [f"{w}x" if k % 6 == 0 and not 24 <= k < 36 else w for k, w in enumerate(own)]
        rows += [(g, prose(g, 40) + own + prose(g + 500, 40)), (g + 1, prose(g + 1, 40) + other + prose(g + 501, 40))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert len({r.doc_id for r in chains.shared_passages(docs).collect()}) == 80


def test_chain_is_best(spark):
    rnd = random.Random(8)

    def best(parts):
        score = []
        for i, (a, b, n) in enumerate(parts):
            ahead = [score[j] - chains.GAP_COST * (a - c - m + b - d - m) for j, (c, d, m) in enumerate(parts[:i]) if c + m <= a and d + m <= b]
            score.append(n + max([0, *ahead]))
        return max(score)

    for _ in range(200):
        parts = sorted((rnd.randrange(200), rnd.randrange(200), rnd.randint(5, 20)) for _ in range(rnd.randint(1, 25)))
        found = chains.chain(parts)
        assert sorted(p for c in found for p in c) == sorted(parts)
        first = found[0]
        assert sum(p[2] for p in first) - sum(chains.GAP_COST * (q[0] - p[0] - p[2] + q[1] - p[1] - p[2]) for p, q in zip(first, first[1:])) == pytest.approx(best(parts))


def test_minimizers_cover_every_window():
    rnd = np.random.default_rng(3)
    words, at = rnd.integers(0, 1 << 62, 2000).astype(np.uint64), np.array([0, 0, 3, 9, 40, 41, 1000, 2000])
    text, pos, _ = chains.minimizers(words, at)
    for t in range(len(at) - 1):
        n, own = at[t + 1] - at[t] - 4, set(pos[text == t].tolist())
        assert bool(own) == (n > 0) and all(0 <= p < n for p in own)
        assert all(any(s + k in own for k in range(chains.WINDOW)) for s in range(max(0, n - chains.WINDOW + 1)))


def test_top_k(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rnd.normal(size=6), 1)]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2050, [float("inf")] * 6), (None, [1.0] * 6), (2100, [1.0, 2.0]), (2101, [3.0, 4.0]), (2150, [])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, score string")
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, v in sound:
        if i % 50 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in sound if j != i and len(w) == len(v))
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(ranked[:5])}
    query = lambda c: F.pmod(c, F.lit(50)) == 0
    for shard, block in ((8192, 4096), (100, 7)):
        assert {tuple(r) for r in balltree.top_k(df, query, shard=shard, block=block).collect()} == want
    huge = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1e18, -1.0]), (2, [-1e18, 0.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in balltree.top_k(huge, query).orderBy("rank").collect()] == [1, 2]
    mixed = [(i, [float(v) for v in rnd.integers(-1000, 1000, 4) * 10.0 ** rnd.integers(0, 8)]) for i in range(300)] + [(300, [1e300, 1.0, 0.0, 0.0]), (301, [-1e305, 1e304, 0.0, 1.0])]
    whole, limit = {i: [int(np.floor(256 * x)) if abs(x) < 1e15 else int(256 * x) for x in v] for i, v in mixed}, 1 << 63
    want = set()
    for i in range(0, 302, 50):
        ranked = sorted((-max(-limit, min(limit - 1, sum(a * b for a, b in zip(whole[i], whole[j])))), j) for j in whole if j != i)
        want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(ranked[:5])}
    assert {tuple(r) for r in balltree.top_k(spark.createDataFrame(mixed, "vec_id long, embedding array<double>"), query, shard=100).collect()} == want
    assert balltree.top_k(df.limit(0), query).count() == 0


def test_language(spark, odd, none):
    words = {"en": "the of and to in is that", "de": "der die und ist nicht ein für", "fr": "le la et que les où été"}
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice(words[lang].split()) for _ in range(60)), lang) for i, lang in enumerate(list(words) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    net = langid.learn(docs.where(~langid.held_out()))
    got = {r.doc_id: r for r in langid.predict(docs.drop("lang"), net).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    strange = langid.predict(odd, net).collect()
    assert len(strange) == len(ODD) and {r.doc_id for r in strange if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert langid.learn(none) is None and {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(none, net).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.learn(docs.where(~langid.held_out()))
    seen = langid.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    assert seen.where("lang = lang_pred").count() >= 0.97 * seen.count()


def test_windows_cover_whole_texts():
    texts = [b"", b"a" * 511, b"b" * 512, b"c" * 1300]
    body, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    x, lengths, counts = langid.to_windows(body, at)
    assert counts.tolist() == [1, 1, 1, 3] and lengths.tolist() == [0, 511, 512, 512, 512, 282]
    assert [w[:n].tobytes() for w, n in zip(x, lengths)] == [b"", texts[1], texts[2], b"c" * 512, b"c" * 512, b"c" * 282]


def _slow_probabilities(net, text):
    """The network by its definition: windows of a text whose every place is covered once, filters byte by byte."""
    step, total, weight = langid.STEP, 0, 0
    for start in range(0, max(1, len(text) - langid.WINDOW + step), step):
        part = text[start : start + langid.WINDOW]
        x, pooled = np.frombuffer(part.ljust(langid.WINDOW, b"\0"), np.uint8), []
        for w in net.filters:
            for f in range(w.shape[2]):
                pooled.append(max(sum(float(net.embed[x[p + k]] @ w[k, :, f]) for k in range(len(w))) for p in range(step)))
        logits = np.maximum(np.array(pooled) + net.bias, 0) @ net.out + net.out_bias
        prob = np.exp(logits - logits.max())
        total, weight = total + prob / prob.sum() * max(1, len(part)), weight + max(1, len(part))
    return total / weight


def test_network_against_its_definition():
    rnd = np.random.default_rng(3)
    net = langid.Network(["a", "b", "c"], rnd.normal(size=(256, 3)), [rnd.normal(size=(w, 3, 2)) for w in langid.WIDTHS], rnd.normal(size=6), rnd.normal(size=(6, 3)), rnd.normal(size=3))
    texts = [b"", b"xyz", bytes(rnd.integers(32, 127, 700, np.uint8))]
    got = langid.Predictor(net).texts(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for own, text in zip(got, texts):
        assert own == pytest.approx(_slow_probabilities(net, text), abs=1e-4)


def test_training_lowers_loss_along_true_gradients():
    """One step of training moves every parameter against the gradient that differences give."""
    rnd = np.random.default_rng(5)
    x, y = rnd.integers(97, 105, (8, langid.WINDOW)).astype(np.uint8), np.arange(8) % 2
    start = langid.train(x, y, ["a", "b"], dims=2, per_width=1, epochs=0)
    after = langid.train(x, y, ["a", "b"], dims=2, per_width=1, epochs=1, batch=8, rate=1e-6)

    def loss(net):
        prob = np.array([langid.Predictor(net).windows(x[i : i + 1])[0] for i in range(8)], np.float64)
        return -np.log(prob[np.arange(8), y]).mean()

    for get in (lambda n: n.out, lambda n: n.out_bias, lambda n: n.bias, lambda n: n.filters[2]):
        at = np.unravel_index(np.abs(get(after) - get(start)).argmax(), get(start).shape)
        moved, base = get(after)[at] - get(start)[at], loss(start)
        get(start)[at] += 0.01
        slope = loss(start) - base
        get(start)[at] -= 0.01
        assert moved == 0 or abs(slope) < 1e-5 or np.sign(moved) == -np.sign(slope)


def test_quality(spark, odd, none):
    rnd, rows, labels = random.Random(10), [], []
    good, bad = prose(1, 60), prose(2, 60)
    for i in range(400):
        rows.append((i, " ".join(rnd.choice(good if i % 2 else bad) for _ in range(50))))
        if i < 200:
            labels.append((i, i % 2, "clash"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    got = dsir.resample(docs, marks).collect()
    assert sum(r.selected for r in got) == 200 and all((r.quality > 0.5) == bool(r.doc_id % 2) for r in got)
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    assert min(r.gumbel_key for r in got if r.selected) == keys[199]
    strange = dsir.resample(odd, marks).collect()
    assert len(strange) == len(ODD) and all(r.log_weight == 0 and r.quality == 0.5 for r in strange if r.doc_id in (1, 2, 3))
    assert dsir.resample(none, marks).count() == 0 and dsir.resample(docs, marks.limit(0)).count() == 400


def test_top_fraction_ties(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)] + [(100, 1e9)], "doc_id long, k double")
    for f in (0.0, 0.2, 0.5, 1.0):
        got = {r.doc_id for r in dsir.top_fraction(df, "k", f, "doc_id").where("selected").collect()}
        assert got == {r.doc_id for r in sorted(df.collect(), key=lambda r: (-r.k, r.doc_id))[: round(f * 31)]}


def test_feature_counts_match_plain_python(spark):
    texts = ["A b a", "", "b", "A B c d"]
    body, at = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    found, ends = dsir.features(body, at)
    assert np.diff(ends).tolist() == [5, 0, 1, 7]
    assert found[0] == found[4] and found[5] == found[2] and found[1] == found[7]
