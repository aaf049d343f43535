import random
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from bibspark.functions.similarity import lcs, ratio, ratios
from bibspark.operators.dedup import dedup, leaders, title_pairs

import pandas as pd


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.text("abcdé ", max_size=90), st.text("abcdé ", max_size=90))
def test_lcs(a, b):
    assert lcs(a, b) == slow_lcs(a, b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc ", max_size=20), st.text("abc ", max_size=20)), max_size=30))
def test_filtered_ratios_miss_nothing(pairs):
    a, b = pd.Series([p[0] for p in pairs], dtype=object), pd.Series([p[1] for p in pairs], dtype=object)
    for x, y, r in zip(a, b, ratios(a, b, 80.0)):
        assert (r == ratio(x, y)) or (r == 0 and ratio(x, y) < 80)


def test_leaders_equal_a_loop(spark):
    rng = random.Random(5)
    nodes = [(f"b{k % 3}", k) for k in range(60)]
    # with a bound of 0 every block is resolved in rounds
    pairs = [(b, i, j) for b, i in nodes for c, j in nodes if b == c and i < j and rng.random() < 0.12]
    got, rounds = ({r.idx: r.keep for r in leaders(spark.createDataFrame(pairs, "block string, i long, j long"), fold).collect()} for fold in (5000, 0))
    want = {}
    for b, i in nodes:
        if i in want:
            continue
        for c, x, j in pairs:
            if x == i and j not in want:
                want[j] = i
    # the first leader that resembles a row is its keeper
    assert got == want == rounds


def test_tiles_miss_no_pair(spark):
    rng = random.Random(8)
    words = ["soil", "waters", "carbon", "trend", "of", "in", "index", "storage", "x"]
    titles = ["soil " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14))) for _ in range(150)] + ["soil" + "y" * 7000, "soil" + "y" * 7001 + "z"]
    rows = [(k, t) for k, t in enumerate(titles)]
    df = spark.createDataFrame(rows, "idx long, TI string")
    first = {}
    for k, t in rows:
        if len(t) > 5:
            first.setdefault(t, k)
    want = {(i, j): ratio(a, b) for a, i in first.items() for b, j in first.items() if i < j and a[:4] == b[:4] and ratio(a, b) >= 90}
    for tile in (1000, 7):
        got = title_pairs(df, tile=tile).collect()
        assert len(got) == len(want) and {(r.i, r.j): r.score for r in got} == want
    assert len(want) > 5


def brute(rows, t=90.0, at=85.0):
    from re import sub

    norm = lambda s: sub(" +", " ", sub("[^a-z0-9 ]", " ", ("nan" if s is None else s).lower())).strip()
    ok = lambda v: v is not None and str(v).strip() not in ("", "nan")
    dup = {}
    for key, kind in (("DI", "doi_exact"), ("UT", "ut_exact")):
        first, found = {}, []
        for r in rows:
            if ok(r[key]):
                if r[key] in first:
                    found.append((r["idx"], first[r[key]], kind))
                else:
                    first[r[key]] = r["idx"]
        for i, k, kd in found:
            dup.setdefault(i, (k, kd))
    left = [r for r in rows if r["idx"] not in dup]
    new = {}
    for n, a in enumerate(left):
        ta = norm(a["TI"])
        if a["idx"] in new or len(ta) <= 5:
            continue
        for b in left[n + 1 :]:
            tb = norm(b["TI"])
            if b["idx"] not in new and len(tb) > 5 and ta[:4] == tb[:4] and ratio(ta, tb) >= t:
                new[b["idx"]] = (a["idx"], "title_similarity")
    dup |= new
    left = [r for r in rows if r["idx"] not in dup]
    new = {}
    au = lambda r: (r["AU"] or "").lower().strip()
    for n, a in enumerate(left):
        if a["idx"] in new or not ok(a["PY"]) or not ok(a["AU"]) or not au(a).split(";")[0].strip():
            continue
        for b in left[n + 1 :]:
            if b["idx"] in new or not ok(b["PY"]) or not ok(b["AU"]) or str(a["PY"]) != str(b["PY"]) or au(a).split(";")[0].strip()[:20] != au(b).split(";")[0].strip()[:20]:
                continue
            x = ratio(au(a), au(b))
            if x >= at and (x + ratio(norm(a["TI"]), norm(b["TI"]))) / 2 >= t:
                new[b["idx"]] = (a["idx"], "author_year_title")
    return dup | new


def test_all_phases_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["soil", "water", "carbon", "trend", "of", "in", "index", "storage"]
    rows = []
    for k in range(120):
        title = " ".join(rng.choice(words) for _ in range(6))
        if k and rng.random() < 0.5:
            title = rows[rng.randrange(k)]["TI"] or title
            if rng.random() < 0.5:
                p = rng.randrange(len(title) or 1)
                title = title[:p] + rng.choice(string.ascii_lowercase) + title[p:]
        rows.append({"idx": k, "record_id": f"r{k}", "source_file": "f", "DI": rng.choice([None, "", " ", f"10.1/{rng.randrange(60)}"]), "UT": rng.choice([None, f"U{rng.randrange(80)}"]),
                     "TI": rng.choice([title, title, title, None]), "AU": rng.choice(["Aa, B; Cc, D", "Aa, B; Cc, E", "", None]), "PY": rng.choice([2001, 2002, None])})
    schema = "idx long, record_id string, source_file string, DI string, UT string, TI string, AU string, PY int"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    kept, m = dedup(df)
    got = {r.record_id: (r.duplicate_of, r.match_type) for r in m.collect()}
    want = {f"r{k}": (f"r{v[0]}", v[1]) for k, v in brute(rows).items()}
    assert got == want and len(want) > 20
    assert kept.count() == len(rows) - len(want)


def test_dedup_of_nothing_and_of_few_columns(spark):
    empty = spark.createDataFrame([], "idx long, record_id string, source_file string, DI string, UT string, TI string, AU string, PY int")
    kept, m = dedup(empty)
    assert kept.count() == 0 and m.count() == 0
    kept, m = dedup(spark.createDataFrame([(1, "a", "f", "10.1/x"), (2, "b", "f", "10.1/x")], "idx long, record_id string, source_file string, DI string"))
    assert [tuple(r) for r in m.collect()] == [("b", "a", "doi_exact", 100.0, "f")]
