import json
import os

import pytest
from pyspark.sql import functions as F

from bibspark.functions import text as X
from bibspark.functions.similarity import register
from bibspark.operators import certify, clean, compat, mapping, screening, validate
from bibspark.plans import audit
from bibspark.plans.pipeline import Pipeline
from bibspark.plans.queries import records
from bibspark.sources import discovery, readers, sinks
from bibspark.streaming import incremental


def value(spark, e, x):
    return spark.createDataFrame([(x,)], "c string").select(e(F.col("c"))).first()[0]


def test_text_functions(spark):
    v = lambda e, x: value(spark, e, x)
    assert v(X.squeeze, "  hello  world  ") == "hello world" and v(X.squeeze, "") == ""
    assert v(X.strip, "\t x \n") == "x"
    assert v(X.normal_semicolons, "a;;") == "a; " and v(X.normal_semicolons, "a ;b") == "a; b"
    assert v(X.normal_authors, "Aa,B;; Cc") == "Aa, B; Cc" and v(X.normal_authors, " ") == " "
    assert v(X.author_order, "Jane B Key; X, Y; One") == "Key, Jane B; X, Y; One"
    assert v(X.keyword_list, "a|b, c;;d") == "a; b; c; d" and v(X.keyword_list, None) == ""
    assert v(X.clean_doi, " https://doi.org/10.1/x ") == "10.1/x"
    assert v(X.countries, "U, A, Peoples R China; V, USA; W") == ["China", "United States"]
    assert v(X.clean_year, "2030.5") is None and v(X.clean_year, "2020.0") == 2020 and v(X.clean_year, "1d") is None and v(X.clean_year, "inf") is None
    assert v(X.compat_year, "abc") == 0
    assert v(X.normal_title, "Étude: A–b  C") == "tude a b c" and v(X.normal_title, None) == ""
    assert v(X.fix_dashes, "aâ\u0080\u0093b ") == "a-b"


def test_registered_functions(spark):
    register(spark)
    r = spark.sql("SELECT indel_ratio('abcd', 'abxd') a, normalize_title('A-b') b, clean_doi('https://dx.doi.org/10.1/x') c").first()
    assert (r.a, r.b, r.c) == (75.0, "a b", "10.1/x")


def test_issues_of_absent_columns_and_bad_years(spark):
    df = spark.createDataFrame([("r", "f", "abc", " ", "x/1")], "record_id string, source_file string, PY string, TI string, DI string")
    got = {(r.field, r.issue_type) for r in validate.validation_issues(df).collect()}
    assert {("AU", "missing_column"), ("SO", "missing_column"), ("PY", "invalid_format"), ("TI", "missing_value"), ("TI", "short_title"), ("DI", "invalid_format")} <= got


def test_names_are_made_unique(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], ["idx", "ti", " TI ", "Ti"])
    assert clean.tag_names(df).columns == ["idx", "TI", "TI_1", "TI_2"]


def test_compat_adds_and_orders(spark):
    df = spark.createDataFrame([(1, "t", "x, Y", None)], "idx long, TI string, AU string, ZZ string")
    out = compat.compatible(df)
    assert out.columns[:3] == ["PT", "AU", "AF"] and out.columns[-1] == "ZZ"
    r = out.first()
    assert (r.PT, r.LA, r.DT, r.PY, len(r.UT)) == ("J", "English", "Article", 0, 13)


def test_database_detection():
    assert mapping.detect_database("PT AU TI SO PY UT AB".split()) == "Web of Science"
    assert mapping.detect_database(["Title", "Authors", "Source", "Year", "DOI"]) == "Scopus"
    assert mapping.detect_database(["Publication ID", "Title", "DOI"]) == "Dimensions"
    assert mapping.detect_database(["PMID", "Title"]) == "PubMed"
    assert mapping.detect_database(["Col1"], ["random.txt"]) == "Unknown"
    assert mapping.detect_database(["x"], ["pmid-set.csv"]) == "PubMed"


def test_mapping_scores(spark):
    good = spark.createDataFrame([("a", "t", "s", 2000, "Article")] * 3, "AU string, TI string, SO string, PY int, DT string")
    f = mapping.field_results(good, "Web of Science")
    assert {r.target_field: r.status for r in f.collect() if r.source_field == "N/A"}["DI"] == "FAILED"
    kept = mapping.preservation(good, good.limit(1))
    assert {r.classification for r in kept.collect() if r.metric == "Record Count"} == {"Unexpected"}
    assert mapping.scores(f, kept).first()["overall_status"] == "FAILED"
    assert {c[1] for c in mapping.unmapped_columns(["Title", "Funding", "CustomField", "AU"], "Scopus")} == {"OPTIONAL", "POTENTIAL_CANDIDATE", "UNUSED"}


def test_many_to_one_mapping(spark):
    df = spark.createDataFrame([(1, " ", "e1"), (2, "s2", "e2")], ["idx", "Scopus ID", "EID"])
    assert [r.UT for r in mapping.to_tags(df, "Scopus").orderBy("idx").collect()] == ["e1", "s2"]


def test_tagged_round_trip_through_files(spark, data, tmp_path):
    r = records(spark, data)
    path = str(tmp_path / "out.txt")
    sinks.write_tagged(r, path)
    back = readers.read_tagged(spark, path)
    assert back.count() == r.count()
    first = {x.UT: x.AB for x in back.collect() if x.UT}
    want = {x.UT.strip(): (x.AB or "").strip() for x in r.collect() if x.UT and x.UT.strip()}
    assert all((first[u] or "") == a for u, a in want.items())


def test_tagged_text_without_end_and_with_windows_lines(spark, tmp_path):
    (tmp_path / "0.txt").write_text("FN Clarivate Analytics Web of Science\nVR 1.0\nPT J\nTI Test\n\nPT J\nTI Test2\n")
    assert [r.TI for r in readers.read_tagged(spark, str(tmp_path / "0.txt")).orderBy("original_index").collect()] == ["Test", "Test2"]
    (tmp_path / "1.txt").write_bytes("﻿FN X\r\nVR 1.0\r\nPT J\r\nAU Aa, B\r\n   Cc, D\r\nTI Long\r\n   title\r\nER\r\n\r\nEF\r\n".encode())
    r = readers.read_tagged(spark, str(tmp_path / "1.txt")).first()
    assert (r.AU, r.TI, r.record_id) == ("Aa, B; Cc, D", "Long title", "1.txt_0")


def test_other_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Title;Authors;Source;Year;DOI\n"A; b";X;S;2001;10.1/x\n')
    assert readers.read_any(spark, str(tmp_path / "a.csv")).first()["TI"] == "A; b"
    (tmp_path / "a.ris").write_text("TY  - JOUR\nTI  - One\nAU  - Aa, B\nAU  - Cc, D\nPY  - 2001\nER  - \n")
    r = readers.read_ris(spark, str(tmp_path / "a.ris")).first()
    assert (r.TI, r.AU, r.PY) == ("One", "Aa, B; Cc, D", "2001")
    (tmp_path / "a.json").write_text('[{"title": "T", "doi": "10.1/x", "cited_by_count": 3, "authorships": [{"a": 1}]}]')
    r = readers.read_any(spark, str(tmp_path / "a.json")).first()
    assert (r.TI, r.DI, r.TC) == ("T", "10.1/x", "3")


def test_pipeline_over_a_folder(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "0.txt").write_text("FN X\nVR 1.0\nPT J\nAU Aa, B\nTI A title of some length\nSO J\nPY 2001\nDT Article\nDI 10.1000/x\nER\n\nPT J\nAU Aa, B\nTI A title of some lengths\nSO J\nPY 2001\nDT Article\nER\n\nEF\n")
    (src / "dim.csv").write_text("Publication ID,Title,DOI,PubYear,Authors,Source title\np1,Another work entirely,10.1000/x,2001,\"Bb, C\",J\n")
    (src / "bad.csv").write_text("")
    s = Pipeline(spark, validate_mapping=True).run(str(src), out)
    assert s.errors == [] and s.counts["imported"] == 3 and s.counts["after_dedup"] == 1
    assert s.counts["duplicates"] == {"doi_exact": 1, "title_similarity": 1}
    assert s.certification["certified"] and s.quality["grade"] in "ABCDF"
    assert all(sinks.verify_outputs(spark, out, ["Master_Dataset.csv", "Bibliometrix_Compatible.csv", "Bibliometrix_Compatible.txt", "Audit_Log.json", "Execution_Summary.md"]).values())
    audit = json.load(open(os.path.join(out, "Audit_Log.json")))
    assert audit["pipeline_stages"]
    assert all(certify.certification_checks(spark, audit, out, "Bibliometrix_Compatible.txt").values())
    assert len(certify.certification_id(spark, os.path.join(out, "PRISMA_Flow.txt"))) == 21
    assert "Records imported" in open(os.path.join(out, "PRISMA_Flow.txt")).read()
    assert all(sinks.verify_outputs(spark, out, ["Mapping_Report", "R_Validation.json"]).values())
    assert certify.required_fields(s.compatible) == []
    assert sinks.read_audit(spark, os.path.join(out, "none.json")) == []


def test_audit_log_and_log_files(spark, tmp_path):
    path = str(tmp_path / "h.json")
    a = audit.AuditLog()
    a.add("import", "PASS", records=3)
    a.add("clean", "FAIL", error="x")
    assert [e["action"] for e in a.of("clean")] == ["FAIL"] and len(a.of()) == 2
    a.save(spark, path)
    a.save(spark, path)
    assert len(audit.load(spark, path)) == 4 and audit.load(spark, str(tmp_path / "none")) == []
    (tmp_path / "broken.json").write_text("{")
    assert audit.load(spark, str(tmp_path / "broken.json")) == []
    log = audit.logger(str(tmp_path / "logs"), "bibspark-test")
    log.info("hello %s", "x")
    assert json.loads((tmp_path / "logs" / "bibspark-test.jsonl").read_text().splitlines()[0])["message"] == "hello x"
    assert audit.plain([{"a": [1, 2], "b": None, "c": True, "d": {"e": 1}}]) == {"a": "[1, 2]", "b": "", "c": True, "d": {"e": 1}} and audit.plain([]) is None is audit.plain("x")


def test_pipeline_on_columns_of_no_known_database(spark, tmp_path):
    df = spark.createDataFrame([(1, "r", "f", "v")], "idx long, record_id string, source_file string, Col1 string")
    s = Pipeline(spark, validate_mapping=True).run(df)
    assert s.counts["mapping"]["overall_status"] == "WARNING" and any("unknown database" in w for w in s.warnings)
    # a stage that fails is in the errors and in the audit log, and the rest goes on
    assert s.errors and {e["stage"] for e in s.audit.entries if e["action"] == "FAIL"} == {x.split(":")[0] for x in s.errors}


def test_discovery(spark, tmp_path):
    sub = tmp_path / "x"
    sub.mkdir()
    (sub / "d.csv").write_text("Publication ID,Title,DOI,PubYear\np,T,10.1/x,2001\n")
    (sub / "w.txt").write_text("FN X\nVR 1.0\nPT J\nAU A\nTI T\nSO S\nPY 2001\nER\n")
    (sub / "skip.doc").write_text("x")
    found = discovery.discover(spark, str(tmp_path))
    assert [os.path.basename(f) for f in found] == ["d.csv", "w.txt"]
    d, w = (discovery.identify(spark, f) for f in found)
    assert (d.database_source, d.export_format, w.database_source, w.encoding) == ("Dimensions", "CSV", "Web of Science", "utf-8")
    assert discovery.level(0.96) == "HIGH" and discovery.level(0.90) == "MEDIUM" and discovery.level(0.70) == "LOW"
    assert discovery.may_merge("A", "A")[0] and "BLOCKED" in discovery.may_merge("A", "B")[1]
    fields, score = discovery.schema_check(spark.createDataFrame([("p", "", None)], "`Publication ID` string, Title string, DOI string"), "Dimensions")
    assert [f["status"] for f in fields] == ["PRESENT", "EMPTY", "EMPTY", "MISSING"] and score == 0.25
    assert discovery.report([d, w])["framework_version"] == "2.0.0"


def test_certification_fails_on_a_broken_export(spark, data, tmp_path):
    fields = ["TI", "AU", "SO", "PY", "DI", "UT"]
    r = compat.compatible(clean.cleaned(records(spark, data)), keep_internal=True)
    path = str(tmp_path / "out.txt")
    sinks.write_tagged(r, path)
    good = certify.reread(r, readers.read_tagged(spark, path), fields)
    assert good["changed"] == [] and certify.certification(True, good)["status"] == "READY_FOR_BIBLIOSHINY" and not certify.certification(False, good)["certified"]
    lost = certify.reread(r, readers.read_tagged(spark, path).where("TI <> ''").limit(5), fields)
    assert not certify.certification(True, lost)["certified"]
    changed = certify.reread(r, readers.read_tagged(spark, path).withColumn("SO", F.upper("SO")), fields)
    assert changed["changed"] == ["SO"] and not certify.certification(True, changed)["certified"]
    # an export without records certifies nothing
    assert not certify.certification(True, certify.reread(r.limit(0), r.limit(0), fields))["certified"]


def test_sync_and_quality_see_differences(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "record_id string")
    same, other = screening.sync_check(ids("a", "b"), ids("b", "a")), screening.sync_check(ids("a", "b"), ids("b", "c", "d"))
    assert same.first()["synchronized"] and tuple(other.first()) == (2, 3, 1, 2, False)
    assert screening.sync_check(ids("a").limit(0), ids("a").limit(0)).first()["synchronized"]
    files = spark.createDataFrame([("f", 5)], "source_file string, records long")
    flow = screening.flow_counts(files, ids(*"abcde"), ids(*"abc"), ids(*"abc"), ids(*"abc"), ids(*"de"))
    assert tuple(flow.first()) == (5, 5, 2, 3, 3, 3, 2)
    issues = ids("a")
    score = lambda f, y: tuple(screening.quality(f, issues, y).first())
    assert score(flow, same) == (100, "PASS", "A") and score(flow, other) == (65, "PASS", "C")
    none = screening.flow_counts(files.limit(0), ids("a").limit(0), ids("a").limit(0), ids("a").limit(0), ids("a").limit(0), ids("a").limit(0))
    assert score(none, screening.sync_check(ids("a").limit(0), ids("a").limit(0)))[::2] == (5, "F")


def test_one_decision_for_each_record(spark):
    rec = spark.createDataFrame([(x, "t", "f") for x in "abcd"], "record_id string, TI string, source_file string")
    m = spark.createDataFrame([("a", "b", "doi_exact", 100.0, "f"), ("a", "c", "ut_exact", 100.0, "f"), ("a", "c", None, None, None), ("b", "b", "x", 1.0, "f"), ("c", None, "x", 1.0, "f"), ("z", "a", "x", 1.0, "f"), ("d", " ", "x", 1.0, "f")], "record_id string, duplicate_of string, match_type string, similarity_score double, source_file string")
    assert [tuple(r) for r in screening.duplicates(m, rec).collect()] == [("a", "b", "doi_exact", 100.0, "f")]


def test_streaming(spark, data, tmp_path):
    src = str(tmp_path / "src")
    schema = "idx long, DI string, UT string, t timestamp"
    rows = lambda *xs: spark.createDataFrame([(i, d, u, None) for i, d, u in xs], schema).coalesce(1).write.mode("append").parquet(src)
    rows((1, "10.1/a", "U1"), (2, "10.1/a", None), (3, None, None))
    run = lambda: incremental.accept(spark, spark.readStream.schema(schema).parquet(src), str(tmp_path / "store"), str(tmp_path / "ck")).awaitTermination()
    run()
    rows((4, "10.1/a", None), (5, "10.1/b", "U1"), (6, "10.1/c", "U2"))
    run()
    got = sorted(r.idx for r in spark.read.parquet(str(tmp_path / "store")).collect())
    assert got == [1, 3, 6]
    ev = spark.read.parquet(f"{data}/events.parquet")
    ev.coalesce(1).write.parquet(str(tmp_path / "ev"))
    st = incremental.arrivals(spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev")), "ts", "event_type")
    q = st.writeStream.format("memory").queryName("arr").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n) FROM arr").first()[0] == ev.count()


def test_detect_database_sees_every_header(spark, data):
    got = {db: mapping.detect_database(list(m)) for db, m in mapping.MAPPINGS.items()}
    assert got["Lens"] == "Lens" and got["PubMed"] == "PubMed" and got["Scopus"] == "Scopus"


def test_files_of_all_formats(spark, tmp_path):
    w = lambda n, t, e="utf-8": (tmp_path / n).write_bytes(t.encode(e))
    w("a.bib", "@article{k1,\n  title = {On {Soil} and\n   water},\n  author = {Aa, B and Cc, D},\n  journal = \"J\",\n  year = 2001\n}\n@book{k2,\n title={Two}, year={2002}\n}\n")
    w("b.enw", "%0 Journal Article\n%T One\n%A Aa, B\n%A Cc, D\n%D 2001\n\n%0 Book\n%T Two\n")
    w("c.xml", "<xml><records><record><titles><title>One &amp; all</title></titles><contributors><authors><author>Aa, B</author><author>Cc, D</author></authors></contributors><dates><year>2001</year></dates></record><record><titles><title>Two</title></titles></record></records></xml>")
    w("d.ciw", "FN X\nVR 1.0\nPT J\nTI One\nER\n\nEF\n")
    w("e.csv", "Title,Authors,Source,Year,DOI\nÉtude,Ñandú,S,2001,10.1/x\n", "cp1252")
    w("f.csv", 'Title,Authors,Source,Year,DOI\n"A\nB",X,S,2001,10.1/x\n')
    w("empty.txt", "")
    read = lambda n: readers.read_any(spark, str(tmp_path / n)).orderBy("original_index").collect()
    a, b, c = read("a.bib"), read("b.enw"), read("c.xml")
    assert [(r.TI, r.AU, r.SO, r.PY) for r in a] == [("On Soil and water", "Aa, B; Cc, D", "J", "2001"), ("Two", "", "", "2002")]
    assert [(r.TI, r.AU) for r in b] == [("One", "Aa, B; Cc, D"), ("Two", "")] and [(r.AU, r.PY) for r in c] == [("Aa, B; Cc, D", "2001"), ("", "")]
    assert read("d.ciw")[0].TI == "One" and read("e.csv")[0].TI == "Étude" and read("e.csv")[0].AU == "Ñandú" and read("f.csv")[0].TI == "A\nB"
    assert [os.path.basename(f) for f in readers.list_files(spark, str(tmp_path))] == ["empty.txt", "e.csv", "f.csv", "a.bib", "b.enw", "c.xml", "d.ciw"]
    with pytest.raises(ValueError):
        readers.list_files(spark, str(tmp_path), 2)
    warned, failed = [], []
    out = readers.import_folder(spark, str(tmp_path), warned.append, failed.append, 7)
    assert out.count() == 9 and failed == [] and any("empty.txt" in x for x in warned)
    with pytest.raises(ValueError, match="different databases"):
        readers.import_folder(spark, str(tmp_path), warned.append, failed.append, one_database=True)


def test_schema_check_sees_malformed_and_lost(spark):
    df = spark.createDataFrame([("p", "T\ufffd", "10.1/x", "n.d."), ("q", "U", "10.1/y", "x")], "`Publication ID` string, Title string, DOI string, PubYear string")
    by = {f["field"]: f for f in discovery.schema_check(df, "Dimensions")[0]}
    assert by["PubYear"]["status"] == "MALFORMED" and not by["Title"]["encoding_valid"] and by["DOI"]["encoding_valid"]


def test_late_rows_and_restart_of_a_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    put = lambda *x: spark.createDataFrame([(k, t) for k, t in x], "k string, t string").selectExpr("k", "cast(t AS timestamp) AS t").coalesce(1).write.mode("append").parquet(src)

    def run():
        st = incremental.arrivals(spark.readStream.schema("k string, t timestamp").parquet(src), "t", "k")
        st.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    put(("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("a", "2024-01-01 09:00:00"))
    run()
    put(("a", "2024-01-01 00:30:00"), ("a", "2024-01-01 09:30:00"), ("b", "2024-01-01 18:00:00"))  # the first is later than the watermark
    run()
    run()
    got = {(r.k, str(r.start)): r.n for r in spark.read.parquet(out).collect()}
    assert got == {("a", "2024-01-01 00:00:00"): 2, ("a", "2024-01-01 09:00:00"): 2}
