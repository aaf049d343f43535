from bibspark.operators.packed import _automaton, explode_packed, mine_dictionary, split_field

WORDS = ["models, biological", "aged, 80 and over", "soil; water"]
KNOWN = {"kw": _automaton(tuple(WORDS)), "c1": _automaton(("univ x, oslo", "lab y, rome, italy")), "au": _automaton(("brun, clair",))}
GIVEN = frozenset(["marta", "joseph", "elizabeth", "kiran", "yusuf"])


def s(text, fld="de"):
    return split_field(text, fld, KNOWN, GIVEN)


def test_delimiters():
    assert s("a b; c d;;e; ") == ["a b", "c d", "e"]
    assert s("a b｜c") == ["a b｜c"]
    assert s("a；b | c·d") == ["a", "b", "c", "d"]
    assert s("a / TCP/IP / b") == ["a", "TCP/IP", "b"]
    assert s("x\ty\nz") == ["x", "y", "z"]


def test_known_values_keep_their_delimiters():
    assert s("x, models, biological, aged, 80 and over") == ["x", "models, biological", "aged, 80 and over"]
    assert s("MODELS, BIOLOGICAL", "id") == ["MODELS, BIOLOGICAL"]
    assert s("models, biological; y") == ["models, biological", "y"]


def test_quotes_lists_entities():
    assert s('"a, b", c, "the ""x"" effect"') == ["a, b", "c", 'the "x" effect']
    assert s("['a', 'b, c', \"d'e\"]") == ["a", "b, c", "d'e"]
    assert s("R&amp;D; Q&amp;A systems") == ["R&amp;D", "Q&amp;A systems"]
    assert s('the "x" effect; y') == ['the "x" effect', "y"]


def test_names():
    assert s("Kikeeau, F", "au") == ["Kikeeau, F"]
    assert s("Drepawalla KN, Remacek FF, Bondaenko T", "au") == ["Drepawalla KN", "Remacek FF", "Bondaenko T"]
    assert s("Krumbaot, M.K. and Drokoford, C.", "au") == ["Krumbaot, M.K.", "Drokoford, C."]
    assert s("Joseph Stostupur, Marta J. Krusawalla and Yusuf N. Didupur", "au") == ["Joseph Stostupur", "Marta J. Krusawalla", "Yusuf N. Didupur"]
    assert s("de la Mekeberg HC, and Gesillo RL", "au") == ["de la Mekeberg HC", "Gesillo RL"]
    assert s('"de Gorušek, S.R.","Stobiling, K.F."', "au") == ["de Gorušek, S.R.", "Stobiling, K.F."]
    assert s("Trambibauer Sturução, Marta", "au") == ["Trambibauer Sturução, Marta"]


def test_addresses():
    assert s("[A, B; C, D] Lab X, Y; Z, W.", "c1") == ["[A, B; C, D] Lab X, Y", "Z, W."]
    assert s('"A, b"; "C, d"', "c1") == ["A, b", "C, d"]
    assert s("; KSCARB, Karnigate", "c1") == ["KSCARB, Karnigate"]


def test_edges():
    assert s(None) == [] and s("") == [] and s(" ; ;") == []
    assert len(s("; ".join(["v"] * 100_000))) == 100_000
    assert s("a; a; a") == ["a", "a", "a"]


def test_operator_on_nulls_clashing_columns_and_empty(spark):
    schema = "idx long, au string, de string, id string, c1 string, fld string, val string, _id int"
    rows = [(1, None, "x, y", None, "", "f", "v", 1), (1, None, "x, y", None, "", "f", "v", 1), (2, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(tuple(r) for r in explode_packed(df).collect())
    assert got == [(1, "de", 1, "x"), (1, "de", 1, "x"), (1, "de", 2, "y"), (1, "de", 2, "y")]
    assert explode_packed(df.limit(0)).count() == 0


def test_fields_that_change_without_the_dictionary():
    for text, fld, want in (
        ("x, models, biological", "de", ["x", "models, biological"]),
        ("x; soil; water; y", "id", ["x", "soil; water", "y"]),
        ("Univ X, Oslo, Lab Y, Rome, Italy", "c1", ["Univ X, Oslo", "Lab Y, Rome, Italy"]),
        ("[A, B] Univ X, Oslo, [C] Lab Y, Rome, Italy", "c1", ["[A, B] Univ X, Oslo", "[C] Lab Y, Rome, Italy"]),
        ("Marin, Brun, Clair, Tek B", "au", ["Marin", "Brun, Clair", "Tek B"]),
    ):
        assert split_field(text, fld, KNOWN, frozenset()) == want != split_field(text, fld)
    # an address is parted at commas only where all of it is known
    assert s("Univ X, Oslo, Lab Z, Rome", "c1") == ["Univ X, Oslo, Lab Z, Rome"]


def test_dictionary_is_mined_from_unmistakable_rows(spark):
    schema = "idx long, au string, de string, id string, c1 string"
    rows = [(k, "Tek, Marta; Roz, Marta K.", "models, biological; x", '"soil; water"; "z"', "[A; B] Univ X, Oslo; Lab Y, Rome") for k in range(5)] + [(9, None, "rare, value; x", None, None)]
    got = {tuple(r) for r in mine_dictionary(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("kw", "models, biological"), ("kw", "soil; water"), ("given", "marta"), ("au", "tek, marta"), ("au", "roz, marta k."), ("c1", "univ x, oslo"), ("c1", "lab y, rome")}


def test_joined_dictionary_gives_what_the_broadcast_one_gives(spark):
    rows = [
        (1, "Roz A, Brun, Clair, Tek B", "x, models, biological, y", "a; soil; water", "Univ X, Oslo, Lab Y, Rome, Italy"), (1, "Roz A, Brun, Clair, Tek B", "x, models, biological, y", None, ""),
        (2, "Roz, Marta, Tek, Marta K.", "['a', 'b, c']", "aged, 80 and over", "[A; B] Univ X, Oslo, Lab Y, Rome, Italy"), (3, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "idx long, au string, de string, id string, c1 string")
    words = [("kw", w) for w in WORDS] + [("c1", "univ x, oslo"), ("c1", "lab y, rome, italy"), ("au", "brun, clair"), ("given", "marta")]
    known = spark.createDataFrame(words, "kind string, v string")
    a, b = (sorted(tuple(r) for r in explode_packed(df, dictionary=known, bound=n).collect()) for n in (10**6, 0))
    assert a == b and (2, "c1", 2, "Lab Y, Rome, Italy") in a and (1, "id", 2, "soil; water") in a and (2, "au", 2, "Tek, Marta K.") in a
