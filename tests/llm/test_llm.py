import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bibspark.llm import canonical, components, garbled, linkage, mixing, names, packing, spam, survivorship
from bibspark.llm.tokens import with_tokens
from bibspark.llm.trie import Trie, allowed, fold


# --- 2 garbled text

TEXTS = ["Avaliação de formação docente na região", "Evaluación – “migración” de l’été à Łódź", "Größere Abweichungen, Straßenverkehr", "Показано, что режимы реки зависят от состава корма", "31.3 ± 6.8 °C, β coefficient, m² and kg ha−1", "Sovoøy; Lukooğlu; Kutušek"]


@pytest.mark.parametrize("enc", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251"])
@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(enc, text):
    def layer(t, e):
        return "".join(chr(garbled._table(e)[b]) for b in t.encode("utf-8"))

    bad = layer(text, enc)
    assert garbled.examine(bad, "ab") == (True, text)
    if enc in ("cp1252", "latin-1"):
        assert garbled.examine(layer(bad, enc), "ab") == (True, text)
    half = text.split(" ", 2)
    if len(half) == 3 and any(ord(c) > 127 for c in half[2]):
        mixed = f"{half[0]} {half[1]} {layer(half[2], enc)}"
        assert garbled.examine(mixed, "ab") == (True, text)


def test_cyrillic_read_as_western():
    t = "Всего исследовано 38 образцов за 1989 год"
    assert garbled.examine(t.encode("cp1251").decode("latin-1"), "ab") == (True, t)


@pytest.mark.parametrize(("read_as", "meant", "text"), [("cp437", "koi8_r", "Влияние удобрений на урожай пшеницы"), ("cp850", "koi8_r", "Влияние удобрений на урожай пшеницы"), ("cp866", "koi8_r", "Влияние удобрений на урожай пшеницы"), ("koi8_r", "cp866", "Показано, что режимы реки зависят от состава корма"), ("koi8_r", "cp866", "Влияние удобрений на урожай пшеницы"), ("koi8_r", "cp866", "Всего исследовано 38 образцов за 1989 год")])
def test_cyrillic_without_a_run_of_accented_letters(read_as, meant, text):
    bad = "".join(chr(garbled._table(read_as)[b]) for b in text.encode(meant))
    assert garbled.examine(bad, "ab") == (True, text)


def test_cyrillic_words_and_doubled_letters():
    assert garbled.examine("зависят от параметры ñðåäû. Показано", "ab") == (True, "зависят от параметры среды. Показано")
    assert garbled.examine("DruruÃ§Ã£Ã£o K", "au") == (True, "Druruçããо K".replace("о", "o"))


@pytest.mark.parametrize("text", [*TEXTS, "ESPAÑOLA, REGIÃO, AVALIAÇÃO", "Is it so? Observations", "How? We ask", "", None, "plain", "SANTÉ” “À L’ÉCOLE”", "Kanduççãoo"])
def test_clean_text_stays(text):
    assert garbled.examine(text, "ti") == (False, None)


SCRIPTS = ["العربية لغة جميلة", "שלום עולם", "中文信息处理", "日本語のテキスト", "Αθήνα και Σπάρτη", "İstanbul'da öğretim ve ağ yapısı", "Příliš žluťoučký kůň úpěl", "한국어 정보", "हिन्दी भाषा", "emoji 😀 ok"]


@pytest.mark.parametrize("text", [*SCRIPTS, "A MANHÃ NA PRAIA", "see http://x.org/p?id=3", "What is life? the answer", "Why?Because", "(?)", "Ça va ? Oui", "ÀÉÎ ÕÜ", "ТЕКСТ ЗАГЛАВНЫМИ", "文", "α-синуклеин"])
def test_clean_text_of_other_scripts_and_questions_stay(text):
    assert garbled.examine(text, "ti") == (False, None) == garbled.examine(text, "ab")


@pytest.mark.parametrize("enc", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
@pytest.mark.parametrize("text", SCRIPTS)
def test_round_trip_of_other_scripts(enc, text):
    def layer(t, e):
        return "".join(chr(garbled._table(e)[b]) for b in t.encode("utf-8"))

    assert garbled.examine(layer(text, enc), "ti") == (True, text)
    deep = text
    for _ in range(6):
        deep = layer(deep, "cp1252")
    assert garbled.examine(deep, "ti") == (True, text)


@pytest.mark.parametrize("text", ["Αθήνα", "Αθήνα και Σπάρτη", "Η μελέτη της ροής"])
def test_greek_read_as_western(text):
    assert garbled.examine(text.encode("cp1253").decode("cp1252"), "ti") == (True, text)


def test_nothing_half_peeled_is_returned():
    assert garbled.examine("caf" + "é".encode().decode("cp1252") + " Ã\x9f", "ti") in ((True, None), (True, "café ß"))
    assert garbled.examine("Ð\x90Ð¼ и Ã©Ð\x81\x81", "ti")[1] is None


@pytest.mark.parametrize("text", ["Evaluaci�n", "Situa??o atual", "Nisho?y, I", "Ãƒ�"])
def test_lost_characters(text):
    assert garbled.examine(text, "au") == (True, None)


def test_garbled_operator(spark):
    bad = "É".encode().decode("latin-1") + "tude"
    rows = [(1, bad, None, "x", "", "clash"), (1, bad, None, "x", "", "clash"), (2, None, "a�b" + "é" * 100_000, None, None, None)]
    df = spark.createDataFrame(rows, "idx long, ti string, ab string, au string, so string, fld string")
    got = sorted(tuple(r) for r in garbled.p2_found(df).collect())
    md5 = hashlib.md5("Étude".encode()).hexdigest()
    assert got == [(1, "ti", md5), (1, "ti", md5), (2, "ab", "")]
    assert garbled.p2_found(df.limit(0)).count() == 0


# --- 5 components


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60), st.sampled_from([3, 10, 10**6]))
def test_components_equal_a_loop(spark, pairs, bound):
    df = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in pairs], "record_id string, duplicate_of string").repartition(4)
    got = {r.record_id: r.group_id for r in components.p5_found(df, bound).collect()}
    group = {}
    for a, b in pairs:
        if a != b:
            a, b = f"n{a}", f"n{b}"
            ga, gb = group.get(a, {a}), group.get(b, {b})
            u = ga | gb
            for x in u:
                group[x] = u
    assert got == {x: min(g) for x, g in group.items()}


def test_chain_and_star_beyond_the_bound(spark):
    chain = [(f"c{k:04}", f"c{k + 1:04}") for k in range(400)]
    star = [("a", f"s{k:04}") for k in range(400)]
    df = spark.createDataFrame(chain + star, "record_id string, duplicate_of string").repartition(8)
    got = {r.record_id: r.group_id for r in components.p5_found(df, 50).collect()}
    assert len(got) == 802 and {g for k, g in got.items() if k[0] == "c"} == {"c0000"} and {g for k, g in got.items() if k[0] in "as"} == {"a"}


def test_components_of_blanks(spark):
    df = spark.createDataFrame([("a", None), ("a", " "), (None, "b"), ("c", "c"), ("d", "e"), ("e", "d")], "record_id string, duplicate_of string")
    assert sorted(tuple(r) for r in components.p5_found(df).collect()) == [("d", "d"), ("e", "d")]
    assert components.p5_found(df.limit(0)).count() == 0


# --- 4 survivorship


def test_abstract_quality():
    q = survivorship.abstract_quality
    assert q("A whole text.") == (0, 0) == q("A whole text. © 2018 Tebidze Verlag") == q("A whole text. Copyright 2022 X House, published under licence. Readers may keep one printed copy.")
    assert q("É".encode().decode("latin-1") + "t whole.") == (1, 0)
    assert q("A cut te [truncated]") == (2, -8) == q("A cut te …") == q("A cut te...") == q("A cut te")
    for t in (None, " ", "[No abstract available]", "n/a", "Abstract missing in the delivery.", "ABSTRACT WITHHELD. The supplier does not pass on summaries.", "This entry came without a summary; whoever needs one."):
        assert q(t) is None
    for t in ("Resumen no disponible.", "Kein Abstract vorhanden", "The publisher gives no summary for this item."):
        assert q(t) is None
    assert q("No effect of lime on yield was found.") == (0, 0)


def test_survivors(spark):
    import datetime as dt

    t = [dt.datetime(2020, 1, k) for k in (1, 2, 3)]
    rec = spark.createDataFrame(
        [("a", "f1", t[0], "Cut …", "X, 1; Y, 2; X, 1", "10.1234/"), ("b", "f2", t[1], "Whole.", "X, 1; Y, 2", "https://doi.org/10.1234/ab"), ("c", "f2", t[1], "Whole too.", "", "doi:10.1234/ab"), ("d", None, None, None, None, None), ("e", "f9", t[2], "Lone.", None, None)],
        "record_id string, source_file string, imported_at timestamp, ab string, cr string, di string",
    )
    grp = spark.createDataFrame([(x, "a") for x in "abcdz"], "record_id string, group_id string")
    src = spark.createDataFrame([("f1", 1), ("f2", 2)], "source_file string, trust_rank int")
    got, joined = (sorted(tuple(r) for r in survivorship.survivors(rec, grp, src, n).collect()) for n in (100, 0))
    assert joined == got == [("a", "ab", "b"), ("a", "cr", "a"), ("a", "di", "b")]
    assert survivorship.survivors(rec.limit(0), grp, src).count() == 0


# --- 6 canonical values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcde", min_size=1, max_size=8), min_size=1, max_size=12), st.text("abcde", min_size=1, max_size=8), st.integers(0, 3))
def test_trie_equals_brute_force(words, query, k):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    t = Trie()
    for n, w in enumerate(words):
        t.add(w, n)
    assert t.search(query, k) == {n: lev(query, w) for n, w in enumerate(words) if lev(query, w) <= k}


def test_journals_and_institutions():
    j = canonical.Journals([(1, "Études de Photographics et Xeromechanics", "Études Photograp. Xeromecha."), (2, "Annals of Phytometrics", "Ann. Phytomet."), (3, "Annals of Photometrics", None)])
    for v, want in {"ETUDES DE PHOTOGRAPHICS ET XEROMECHANICS": 1, "Études Photograp. Xeromecha": 1, "The Annals of Phytometrics, 59(6)": 2, "Ananls of Photometrics": 3, "Yearbook of the Corte Society": 0, "Ã‰tudes de Photographics et Xeromechanics": 1, "": 0}.items():
        assert j.lookup(v)[1] == want, v
    i = canonical.Institutions([(5, "University of Ithvahollow", "UITH", "Ithvahollow"), (6, "Ithvahollow General Hospital", "IGH", "Ithvahollow"), (7, "University of Kelledonia", "UKEL", "Kelledonia")])
    for v, want in {"[A, B; C] Dept X, Univ Ithvaholow, 123 Ithvahollow, Brazil": 5, "Ithvahollow Gen. Hosp., Ithvahollow": 6, "UKEL, Kelledonia": 7, "Botanic Garden Kelledonia, Kelledonia": 0, "Universität Kelledonia": 7, "": 0}.items():
        assert i.lookup(v)[1] == want, v


def test_short_cities_and_short_titles():
    i = canonical.Institutions([(5, "University of Oslo", "UIO", "Oslo"), (6, "New York University", "NYU", "New York"), (7, "University of Bonn", "UBO", "Bonn")])
    for v, want in {"University of Oslo": 5, "Dept X, New York University, USA": 6, "University of Bern": 0, "University of Oslo, Oslo": 5}.items():
        assert i.lookup(v)[1] == want, v
    j = canonical.Journals([(1, "Gut", None), (2, "BMJ", None), (3, "Annals of Phytometrics", None)])
    assert [j.lookup(v)[1] for v in ("Gut", "BMJ", "Gus", "Annals of Phytometrics")] == [1, 2, 0, 3]


def test_map_values_edges(spark):
    rec = spark.createDataFrame([(1, " ", None), (2, None, "UKEL, K; ?"), (3, "x" * 50_000, "")], "idx long, so string, c1 string")
    jr = spark.createDataFrame([(1, "Annals of X", "Ann. X")], "ref_id int, journal_title string, iso_abbrev string")
    ins = spark.createDataFrame([(7, "University of Kelledonia", "UKEL", "Kelledonia")], "ref_id int, org_name string, acronym string, city string")
    assert sorted(tuple(r) for r in canonical.map_values(rec, jr, ins).collect()) == [(2, "c1", 1, 7), (2, "c1", 2, 0), (3, "so", 1, 0)]
    assert canonical.map_values(rec, jr.limit(0), ins.limit(0)).where("ref_id <> 0").count() == 0
    assert allowed(4) == 0 and fold("Łódź & Øst�r") == "lodz and ost~r"


def test_one_word_names_and_short_words():
    i = canonical.Institutions([(5, "Kelinstitut", "KI", "Kel"), (6, "University of Oslo", "UIO", "Oslo")])
    assert [i.lookup(v)[1] for v in ("Kelinstitut", "Dept X, Kelinstitt, Kel", "Oslo", "University of Oslo, Oslo")] == [5, 5, 0, 6]
    j = canonical.Journals([(1, "BMJ Open", None), (2, "Gut", None)])
    assert [j.lookup(v)[1] for v in ("BMJ Opn", "bmj open", "Gut.")] == [1, 1, 2]


def test_a_long_list_in_shards_gives_the_same(spark):
    jr = [(k, f"{a} of {b}", None) for k, (a, b) in enumerate(((a, b) for a in ("Annals", "Journal", "Review") for b in ("Phytometrics", "Photometrics", "Thermology", "Cytogenics")), 1)]
    ins = [(50 + k, f"{a} {c}", None, c) for k, (a, c) in enumerate((a, c) for a in ("University of", "Botanic Garden") for c in ("Kelledonia", "Ithvahollow", "Selmiquay"))]
    rec = [(1, "Ann. Phytometrics", "Univ Kelledonia, Kelledonia; Botanic Gardn Selmiquay"), (2, "Jour of Thermolgy", "Ithvahollow University"), (3, "Review of Photometrics, 3(1)", "x"), (3, "", None)]
    args = [spark.createDataFrame(rec, "idx long, so string, c1 string"), spark.createDataFrame(jr, "ref_id int, journal_title string, iso_abbrev string"), spark.createDataFrame(ins, "ref_id int, org_name string, acronym string, city string")]
    whole, shards = (sorted(tuple(r) for r in canonical.map_values(*args, most=m).collect()) for m in (100, 2))
    assert whole == shards and sum(r[3] > 0 for r in whole) == 6


def test_a_list_to_broadcast_is_checked(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "ref_id int, name string")
    assert canonical.bounded_list(df, ["ref_id", "name"], 2) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        canonical.bounded_list(df, ["ref_id", "name"], 1)


# --- 3 names


def test_name_parts():
    p = names.parse_person
    assert p("van der Sovoøy, Q.") == ("sovooy", "q", "") and p("Fikorez-Duvakar RD") == ("fikorez duvakar", "r", "d")
    assert p("José E. dos Trudaenko") == ("trudaenko", "jose", "e") and p("Felix R. Timbeeau Pupemoto") == ("timbeeau pupemoto", "felix", "r") and p(None) == ("", "", "")
    assert names.same_given("chuck", "charles") and names.same_given("memo", "mehmet") and not names.same_given("zora", "zdenek")
    assert names.same_surname("kataot borvistrom", "borvistrom") and names.same_surname("drishooey", "drishooy") and not names.same_surname("kilunin", "kandiling")
    assert names.same_org("regional archive ardtovaport", "regional arhcive ardtovaport") and not names.same_org("school nursing x @x", "school nursing x @y")


def test_initials_go_to_the_one_person_they_fit():
    forms = [("zora", "", "", "", 3), ("zdenek", "g", "", "", 3), ("z", "", "", "", 1), ("z", "g", "", "", 1), ("irma", "", "", "", 2), ("i", "t", "", "", 1)]
    n = names.tell_apart(forms)
    assert n[0] != n[1] and n[3] == n[1] and n[2] not in (n[0], n[1]) and n[4] == n[5]


def test_p3(spark):
    rows = [
        (1, "person", "Kandiling, W.", None, "RTUAV, Ravmeminster, Iran"), (2, "person", "KANDILING, Weronika", None, "Ravmeminster Tech Univ, Ravmeminster"), (3, "person", "Weronika Kandilling", None, "Dept X, Ravmeminster Technical University, Ravmeminster, Iran"),
        (4, "person", "Kandiling, W", None, "Kelledonia Gen Hosp, Kelledonia"), (5, "person", "Kandiling, W", "Kandiling, Weronika", None), (6, "person", None, None, None),
        (7, "organisation", None, None, "Ornis Botanic Garden, Ornisto, Italy"), (8, "organisation", None, None, "Ornisto Botanic Gardn, 123 Ornisto"), (9, "organisation", None, None, "Ornisto Water Agency, Ornisto"), (10, "organisation", None, None, None),
    ]
    rows[6] = (7, "organisation", None, None, "Ornisto Botanic Garden, Ornisto, Italy")
    m = spark.createDataFrame(rows, "mention_id long, kind string, au string, af string, c1 string")
    ins = spark.createDataFrame([(1, "Ravmeminster Technical University", "RTUAV", "Ravmeminster"), (2, "Kelledonia General Hospital", "KGH", "Kelledonia")], "ref_id int, org_name string, acronym string, city string")
    jr = spark.createDataFrame([(1, "Annals of X", "Ann. X")], "ref_id int, journal_title string, iso_abbrev string")
    got = {tuple(r) for r in names.p3_found(m, ins, jr).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (1, 5), (2, 5), (3, 5), (7, 8)}
    assert names.p3_found(m.limit(0), ins, jr).count() == 0


def test_p3_without_address(spark):
    at = "Ravmeminster Technical University, Ravmeminster, Iran"
    rows = [
        (1, "Kandiling, Weronika", at), (2, "Kandilnig, Weronika", None), (3, "Kandiling, Weronkia", None), (4, "Kandiling, Zora", None),
        (5, "Trudaenko, Guillermo", None), (6, "Trudeanko, Guillermo", None), (7, "Trudaenko, Guilermo", None), (8, "Trudaenko, Irma", None), (9, "Trudaenko, G.", None),
    ]
    m = spark.createDataFrame([(i, "person", au, None, c1) for i, au, c1 in rows], "mention_id long, kind string, au string, af string, c1 string")
    ins = spark.createDataFrame([(1, "Ravmeminster Technical University", "RTUAV", "Ravmeminster")], "ref_id int, org_name string, acronym string, city string")
    jr = spark.createDataFrame([(1, "Annals of X", "Ann. X")], "ref_id int, journal_title string, iso_abbrev string")
    want = [(1, 2, 3), (5, 6, 7, 9)]
    assert {tuple(r) for r in names.p3_found(m, ins, jr).collect()} == {(a, b) for w in want for a in w for b in w if a < b}


def test_p3_frequent_spellings_with_one_given_name(spark):
    at = "Ravmeminster Technical University, Ravmeminster, Iran"
    au = ["Drelistroem, Emre"] * 2 + ["Drelistrom, Emre"] * 3 + ["Drelistroem, Zora"] * 2 + ["Drelistrom, Hanna"] * 3
    m = spark.createDataFrame([(i, "person", x, None, at) for i, x in enumerate(au)], "mention_id long, kind string, au string, af string, c1 string")
    ins = spark.createDataFrame([(1, "Ravmeminster Technical University", "RTUAV", "Ravmeminster")], "ref_id int, org_name string, acronym string, city string")
    jr = spark.createDataFrame([(1, "Annals of X", "Ann. X")], "ref_id int, journal_title string, iso_abbrev string")
    want = [range(5), (5, 6), (7, 8, 9)]
    assert {tuple(r) for r in names.p3_found(m, ins, jr).collect()} == {(a, b) for w in want for a in w for b in w if a < b}


def test_name_index_reaches_all_similar_tokens(spark):
    for a, b in (("kim", "kin"), ("wei", "we"), ("sovoyy", "savayy"), ("trudaen", "trudoin"), ("abcde", "abxdef")):
        assert names.similar(a, b) and names.deletions(a) & names.deletions(b)
    rows = [("", "regional archive", 9), ("", "regional archive ardtovaport", 1), ("", "regional archive selmiport", 1), ("", "school nursing", 5)]
    nodes = spark.createDataFrame(rows, "scope string, name string, n long")
    got = {r.name: r.root for r in names._link(nodes, names.same_org, frozenset("regional archive school nursing".split())).collect()}
    assert got["regional archive ardtovaport"] == got["regional archive"] != got["school nursing"]


# --- 7 linkage


def test_votes():
    J = canonical.Journals([(1, "Annals of Thermographics", "Ann. Thermograp.")])
    P = lambda t, a, j, y: linkage.profile(t, a, j, y, J, {})[:7]
    full = "Effects of solar yield on biogas output in Zeltosaburg"
    a = P(full, "Aa, B.; Cc, D.", "ANN THERMOGRAP", 2001)
    assert linkage.votes(a, P("<i>Effects</i> of solar yeild on biogas output in Zeltosaburg", "Cc D, Aa B", "Annals of Thermographics, 2(1)", 2002)) == (1, 1, -1, 1, 1, 1, 1, None)
    assert linkage.votes(a, P("Effects fo solar yield on biogas...", "Aa, B et al.", None, None)) == (1, 1, 1, 1, None, None, None, None)
    assert linkage.votes(a, P("Effects of soil carbon...", None, None, None))[0] == -1
    for t in ("Correction to: {}", "Reply to: {}", "Book review of: {}", "{} in a second season", "{}: a postscript"):
        assert linkage.votes(a, P(t.format(full), "Aa, B.; Cc, D.", "Ann. Thermograp.", 2001))[6] == -1, t
    assert linkage.votes(P(f"{full}: Part II", None, None, None), P(f"{full}: Part III", None, None, None))[7] == -1
    assert linkage.votes(a, P(full.replace("Zeltosaburg", "Morbaville"), "Aa, B.; Cc, D.", "Ann. Thermograp.", 2001))[0] == -1
    assert linkage.votes(P(None, None, None, None), a) == (None,) * 8


def test_label_model_learns_who_is_right():
    rng = np.random.default_rng(1)
    kind = rng.choice(3, 6000, p=[0.3, 0.1, 0.6])
    says = np.array([[0.97, 0.95, 0.9, 0.9, 0.9, 0.9, 0.97, 0.9], [0.03, 0.5, 0.9, 0.9, 0.7, 0.9, 0.05, 0.4], [0.02, 0.02, 0.05, 0.05, 0.3, 0.1, 0.1, 0.2]])
    v = np.where(rng.random((6000, 8)) < says[kind], 1.0, -1.0)
    v[rng.random((6000, 8)) < 0.1] = np.nan
    pats, inv, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post = linkage.fit_label_model(pats, n.astype(float))[inv.ravel()]
    truth = kind == 0
    assert ((post > 0.5) == truth).mean() > 0.98
    # a higher threshold gives up matches for fewer mistakes
    reach = [((post >= t) & truth).sum() for t in (0.1, 0.5, 0.99, 0.9999)]
    wrong = [((post >= t) & ~truth).sum() for t in (0.1, 0.5, 0.99, 0.9999)]
    assert sorted(reach, reverse=True) == reach and reach[0] > reach[-1] and sorted(wrong, reverse=True) == wrong and wrong[0] > wrong[-1]
    assert len(linkage.fit_label_model(np.zeros((0, 8)), np.zeros(0))) == 0


def _plans(spark, run):
    """The plans of all that ``run`` executes, as they ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    done = store.executionsList()
    return [done.apply(k).physicalPlanDescription() for k in range(min(before, done.size()), done.size())]


def test_p3_sends_no_table_to_the_driver(spark):
    rows = [(1, "person", "Kuzmelanov, I.", "Kuzmelanov, Ivan", "Univ Somewhere, Riga"), (2, "person", "Kuzmelanow, I.", "Kuzmelanow, Ivan", "Univ Somewhere, Riga"), (3, "person", "Kuzmelanov, Ivan", None, None)]
    m = spark.createDataFrame(rows, "mention_id long, kind string, au string, af string, c1 string")
    inst = spark.createDataFrame([(5001, "Institute of Things", None, "Bonn", "Germany")], "ref_id int, org_name string, acronym string, city string, country string")
    jour = spark.createDataFrame([(1001, "Annals of Things", "Ann. Things", None)], "ref_id int, journal_title string, iso_abbrev string, issn string")
    found = []
    plans = _plans(spark, lambda: found.extend(map(tuple, names.p3_found(m, inst, jour).collect())))
    assert sorted(found) == [(1, 2), (1, 3), (2, 3)]
    assert len(plans) > 20 and any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastExchange" in p for p in plans)


def test_p7_sends_no_table_to_the_driver(spark):
    b = spark.createDataFrame([(1, "Nitrate removal by willow roots in Ostrava", "Kusel, M.; Tonar, B.", "Ann. Things", 2001)], "idx long, ti string, au string, so string, py int")
    d = spark.createDataFrame([("p1", "Nitrate removal by willow roots in Ostrava", "Kusel, M.; Tonar, B.", "Ann. Things", 2001)], "publication_id string, title string, authors string, source_title string, pubyear int")
    jour = spark.createDataFrame([(1001, "Annals of Things", "Ann. Things")], "ref_id int, journal_title string, iso_abbrev string")
    found = []
    plans = _plans(spark, lambda: found.extend(linkage.link(b, d, jour, threshold=0.0).collect()))
    assert [(r.idx, r.publication_id) for r in found] == [(1, "p1")]
    keys = {k for p in plans for k in re.findall(r"\) BroadcastHashJoin.*\nLeft keys \[\d+\]: \[(\w+)#", p)}
    assert any("SortMergeJoin" in p for p in plans) and keys <= {"pattern"}  # the patterns of votes are bounded


def test_link_edges(spark):
    b = spark.createDataFrame([(1, "Soil carbon storage in Zeltosaburg meadows", "Aa, B", "J", 2001), (2, None, None, None, None), (3, "Soil carbon storage in Zeltosaburg meadows", "Aa, B", "J", 2001)], "idx long, ti string, au string, so string, py int")
    d = spark.createDataFrame([("p", "SOIL CARBON STORAGE IN ZELTOSABURG MEADOWS", "Aa B", "J", 2001), ("q", None, None, None, None)], "publication_id string, title string, authors string, source_title string, pubyear int")
    jr = spark.createDataFrame([(1, "Annals of X", "Ann. X")], "ref_id int, journal_title string, iso_abbrev string")
    got = linkage.link(b, d, jr).collect()
    assert {(r.idx, r.publication_id) for r in got} == {(1, "p"), (3, "p")} and all(0.5 <= r.confidence <= 1 for r in got)
    assert linkage.link(b.limit(0), d, jr).count() == 0


def test_common_words_and_misspelt_names_still_share_a_key(spark):
    cols = "side string, ph long, title string, cut boolean, names array<string>, words array<string>, journal string, year int"
    title = "effects of sediment load on lake stratification in"
    row = lambda side, ph, t, cut, names, j, y: (side, ph, t, cut, names, [w for w in dict.fromkeys(t.split()) if len(w) > 2], j, y)
    rows = [
        row("b", 1, f"{title} kelbagaville", False, ["brineau", "trembuton", "histemoto", "furvakar", "zelin"], "#7", 2011), row("d", 2, title, True, ["brineais", "trembuton", "histemoto", "furvakar", "aelin"], "#7", 2010),
        row("b", 3, f"{title} morbaville", False, [], "#8", 1999), row("d", 4, title, True, ["x"], "", 1999), row("d", 5, f"{title} morbavile", False, ["y"], "#8", 2000),
        row("b", 6, "sediment load of lakes", False, ["aa", "bb", "cc", "dd"], "", None), row("d", 7, "load of lake sediment", False, ["dd", "ee", "ff", "gg"], "", None),
    ]
    frequent = [*title.split(), "lakes"]
    k = linkage.candidate_keys(spark.createDataFrame(rows, cols), frequent)
    assert {tuple(r) for r in linkage.candidates(k).collect()} == {(1, 2), (3, 4), (3, 5), (6, 7)}
    assert linkage.candidate_keys(spark.createDataFrame(rows, cols).limit(0), []).count() == 0


def test_candidates_reach_what_the_votes_accept(spark, data):
    """Of all pairs of the smallest tables, those whose votes speak for one publication are candidates."""
    t = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    journals = canonical.Journals([tuple(r) for r in t("journals").select("ref_id", "journal_title", "iso_abbrev").collect()])
    P = lambda rows: [(r[0], linkage.profile(*r[1:], journals, {})[:7]) for r in rows]
    left, right = P(t("bib_records").select("idx", "ti", "au", "so", "py").collect()), P(t("dimensions_rows").select("publication_id", "title", "authors", "source_title", "pubyear").collect())
    want = set()
    for i, a in left:
        for q, b in right:
            v = linkage.votes(a, b)
            if v[0] == 1 and -1 not in (v[3], v[6], v[7]) and sum(x for x in v if x is not None) >= 4:
                want.add((i, q))
    got = {(r.idx, r.publication_id) for r in linkage.link(t("bib_records"), t("dimensions_rows"), t("journals"), threshold=-1.0).collect()}
    assert len(want) > 10 and len(want - got) <= 0.02 * len(want)


# --- 8 packing


def naive(sizes, cap):
    rooms, out = [], []
    for s in sizes:
        fit = [(r, k) for k, r in enumerate(rooms) if r >= s]
        if fit:
            k = min(fit)[1]
            rooms[k] -= s
        else:
            k = len(rooms)
            rooms.append(cap - s)
        out.append(k)
    return len(rooms), out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(60, 100))
def test_best_fit_equals_naive(sizes, cap):
    sizes = sorted(sizes, reverse=True)
    got = packing.best_fit_decreasing(sizes, cap)
    assert len(set(got)) == naive(sizes, cap)[0]
    used = {}
    for s, b in zip(sizes, got):
        used[b] = used.get(b, 0) + s
    assert all(u <= cap for u in used.values())


@pytest.mark.parametrize("bound", [5, 500_000])
def test_packing_keeps_every_token_once(spark, bound):
    rng = random.Random(2)
    rows = [(k, " ".join(["word"] * rng.choice([1, 3, 9, 30, 200])), "clash") for k in range(80)] + [(900, None, ""), (901, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bin_id string")
    specs = spark.createDataFrame([(1, 32), (2, 64)], "spec_id int, capacity_tokens int")
    n = {r.doc_id: r.n_tokens for r in with_tokens(docs, ["doc_id"]).collect()}
    out = packing.pack(docs, specs, bound).collect()
    for spec, cap in ((1, 32), (2, 64)):
        mine = [r for r in out if r.spec_id == spec]
        used, got = {}, {}
        for r in mine:
            used[r.bin_id] = used.get(r.bin_id, 0) + r.n_tokens
            got.setdefault(r.doc_id, []).append((r.start_token, r.n_tokens))
        assert max(used.values()) <= cap
        for d, ps in got.items():
            ps.sort()
            assert sum(p[1] for p in ps) == n[d] and all(a + b == c for (a, b), (c, _) in zip(ps, ps[1:]))
            assert len(ps) == -(-n[d] // cap)
        assert set(got) == {d for d, k in n.items() if k}
    with pytest.raises(ValueError):
        packing.pack(docs, spark.createDataFrame([(1, 0)], "spec_id int, capacity_tokens int"))
    assert packing.pack(docs.limit(0), specs).count() == 0


# --- 9 mixing


def test_mixing(spark):
    rows = [(k, "one two three four", "a") for k in range(300)] + [(1000 + k, "one two three four", "b") for k in range(10)] + [(2000, None, "a"), (2001, "x", None), (2002, "x", "unlisted")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.4, 3), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    out, rep = mixing.mix(docs, t)
    got = out.collect()
    n = {}
    for r in got:
        n.setdefault(r.source, {}).setdefault(r.doc_id, []).append(r.copy)
    assert set(n) == {"a", "b"} and all(c == list(range(1, len(c) + 1)) for s in n.values() for c in map(sorted, s.values()))
    assert max(map(len, n["b"].values())) == 3 and len(n["b"]) == 10 and max(map(len, n["a"].values())) <= 1
    r = {x.source: x for x in rep.collect()}
    assert r["b"].capped and not r["a"].capped and r["none"].tokens == 0 and abs(r["a"].supplied - 1) < 0.03
    assert abs(sum(x.actual_share for x in r.values()) - 1) < 1e-9
    # the total is what the smaller source reaches at its cap: both keep their shares
    assert abs(r["a"].actual_share - 5 / 9) < 0.02 and abs(r["b"].actual_share - 4 / 9) < 0.02
    _, rep = mixing.mix(docs, t, keep_shares=False)
    r = {x.source: x for x in rep.collect()}
    assert r["b"].capped and r["b"].actual_share < 0.2 and abs(r["a"].supplied - 1) < 0.03
    exact, rep = mixing.mix(docs, t.where("source <> 'none'"), total_tokens=100)
    assert all(abs(x.supplied - 1) < 0.2 for x in rep.collect())
    empty, rep = mixing.mix(docs.limit(0), t)
    assert empty.count() == 0 and rep.count() == 3


# --- 10 spam


SPAM = {
    1: "Best free trial and free trial discount. The free trial with free trial certificate. Our free trial for free trial free trial. Top free trial by free trial certificate",
    2: "Samples were taken at the lake.\n\n" + "\n".join(f"- [low fee](http://x{k}.test/p/{k})" for k in range(15)),
    3: "#lowfee #thesis_help #lab-kits #lowfee #discount #thesis_help #lowfee #lab_kits #discount #lowfee #lowfee #lab-kits",
    4: "pollen load; low fee; bark tannins; thesis help; peak load; lab kits; herd size; low fee; wing length; lab kits; heat waves; low fee",
    5: " | ".join(f"http://h{k}.test/a/{k}" for k in range(15)),
    6: " ".join(f"Lab Kits SKU {k}4021 €{k}2.50 In stock Low Fee Art. 2{k} $9.10 Add to cart" for k in range(6)),
}
HONEST = {
    11: "References\n[1] Kolivik C, Fagoford S. Wing length and gut flora: evidence from Bravarafield. Rev. Mycol. 2023;75:462.\n[2] Gimbeeau B. Herd size in the lake. Ann. Phytomet. 1989;37:507.",
    12: "Cytogenics Letters\nVolume 66, Issue 10\nYears of herbs records at Ostbevefield .... 91\nThe role of leaf extracts in reliable bark tannins .... 76\nResin yield under reliable conditions near Ostna .... 307",
    13: "Glossary\nRoot biomass: the higher state of humus content as used in this report.\nHumus content: the stable state of root biomass as used in this report.",
    14: "Heat waves follows heat waves of the last group, since storm tracks was local at X. Heat waves differs from heat waves of the third group, since drought was uneven at Y.",
    15: "We measured pollen load at 54 sites. low fee, thesis help, lab kits were named as warning signs of unfair offers; the results show an effect of herd size.\nKeywords: pollen load; herd size; wing length; bark tannins",
    16: "Demo works at the institute in Y. The profile page is http://a.test/p/1 and the reading list is at http://b.test/p/2.",
    17: None, 18: "", 19: "low fee",
}


def test_spam(spark):
    rows = [(k, t, f"site{k % 4}") for k, t in (SPAM | HONEST).items()] + [(30 + k, t, None) for k, t in SPAM.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, site string")
    got = {r.doc_id for r in spam.spam_pages(docs).collect()}
    assert got == set(SPAM) | {30 + k for k in SPAM}
    assert spam.spam_pages(docs.limit(0)).count() == 0
    assert spam.evidence("low fee, " * 50_000)[0] == 100_000
    # no page is flagged for its form alone: another host must have its phrases
    alone = spark.createDataFrame([(k, t, "one.test") for k, t in SPAM.items()], "doc_id long, text string, site string")
    assert spam.spam_pages(alone).count() == 0


def test_phrases_of_a_page():
    n = lambda t: sorted(np.unique(spam.shingles(t, spam._Hashes()), return_counts=True)[1].tolist())
    assert n("low fee, low fee") == [2, 2, 2] and n("low; fee") == [1, 1] and n(None) == [] == n(" ;")
    assert n("see https://www.a-b.test/buy/1") == [1] * 10  # see; a b test buy 1 and their neighbours
    assert len(np.unique(spam.shingles("wing length " * 50_000, spam._Hashes()))) == 4


def test_nothing_else_imports_this_package():
    import pathlib

    root = pathlib.Path(spam.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "bibspark.llm" not in f.read_text() and "from .llm" not in f.read_text()


def test_sql_of_this_package(spark, data):
    import duckdb

    from bibspark.llm.queries import queries
    from bibspark.llm.sql import oracle_sql

    con = duckdb.connect()
    for t in ("bib_records", "duplicate_mappings", "source_files", "documents", "mix_targets", "pack_specs"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        got = queries()[name](spark, data)
        assert sorted(tuple(r) for r in got.select(*sorted(got.columns)).collect()) == sorted(con.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({sql})").fetchall())


def test_p10_list_of_phrases_that_no_other_host_has(spark):
    words = [a + b for a in ("ka", "lo", "mi", "ru", "te") for b in ("bar", "den", "fos", "gul", "nim")]
    own = "; ".join(f"{a} {b}" for a, b in zip(words, words[7:] + words[:7]))
    prose = [f"We saw that the {w} is in the {v} of the year and it was not as they had said." for w, v in zip(words, words[11:] + words[:11])]
    rows = [(1, own, "one.example")] + [(10 + k, t, f"h{k}.example") for k, t in enumerate(prose)]
    schema = "doc_id long, text string, site string"
    assert spam.suspicious(*spam.evidence(own))
    # its words are all on other hosts, its phrases aren't
    assert spam.spam_pages(spark.createDataFrame(rows, schema)).count() == 0
    more = [*rows, (2, own, "two.example")]
    assert sorted(r.doc_id for r in spam.spam_pages(spark.createDataFrame(more, schema)).collect()) == [1, 2]
