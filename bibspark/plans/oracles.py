"""DuckDB statements for the core queries, written independently of the Spark expressions."""

from __future__ import annotations

# Fixed values, written out here once more so that a wrong one in the library shows.
TAGS = "PT AU AF TI SO LA DT DE ID AB C1 RP EM FU FX CR NR TC Z9 U1 U2 PY PU PI PA SN EI J9 JI PD VL IS BP EP DI PG WC SC GA UT DA".split()
MANDATORY = "AU TI SO PY DT DI DE ID CR C1 RP TC LA".split()
VALID_MANDATORY = "TI AU SO PY DT".split()
VALID_RECOMMENDED = "AB DE DI UT C1".split()
TEXT_ALWAYS = "PT AU TI SO PY DT DE C1 RP CR UT LA".split()
WRAPPED = "AU AF C1 DE ID CR AB FX FU".split()
DIMENSIONS_TAGS = "TI AU SO PY DI DE".split()
COUNTRY_NAMES = {
    "usa": "United States", "us": "United States", "u.s.a.": "United States", "u.s.": "United States",
    "uk": "United Kingdom", "u.k.": "United Kingdom", "england": "United Kingdom", "scotland": "United Kingdom", "wales": "United Kingdom",
    "peoples r china": "China", "pr china": "China", "china pr": "China",
    "s korea": "South Korea", "republic korea": "South Korea", "south-korea": "South Korea", "ussr": "Russia", "soviet union": "Russia",
}
#: Tags of the table by measure of preservation.
GROUPS = {"Document Count": ["TI"], "Author Count": ["AU"], "DOI Count": ["DI"], "Journal Count": ["SO"], "Keyword Count": ["DE", "ID"], "Affiliation Count": ["C1"]}

_TAGS = "pt au af ti so py dt di de id ab cr c1 rp tc la ut".split()


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}\x{{0B}}\x{{85}}]+|[\s\p{{Z}}\x{{0B}}\x{{85}}]+$', '', 'g')"


def blank(x: str) -> str:
    return f"coalesce({strip(f'cast({x} AS varchar)')} = '', true)"


def filled(x: str) -> str:
    return f"(NOT {blank(x)} AND cast({x} AS varchar) <> 'nan')"


def parts(x: str, sep: str = ";") -> str:
    return f"list_filter(list_transform(string_split({x}, '{sep}'), lambda p: {strip('p')}), lambda p: p <> '')"


def title(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def semicolons(x: str) -> str:
    return rf"regexp_replace({strip(rf'''regexp_replace({x}, '\s*;\s*', '; ', 'g')''')}, ';+$', '')"


def dashes(x: str) -> str:
    return strip(f"regexp_replace({x}, 'â\x80[\x90-\x9f]', '-', 'g')")


def authors(x: str) -> str:
    one = f"CASE WHEN instr(p, ',') > 0 THEN concat({strip('''split_part(p, ',', 1)''')}, ', ', {strip('''substr(p, instr(p, ',') + 1)''')}) ELSE p END"
    return f"CASE WHEN {blank(x)} THEN {x} ELSE array_to_string(list_transform({parts(x)}, lambda p: {one}), '; ') END"


def doi(x: str) -> str:
    return f"CASE WHEN {blank(x)} THEN {x} ELSE regexp_replace(regexp_replace({strip(x)}, 'https?://doi\\.org/', '', 'g'), 'https?://dx\\.doi\\.org/', '', 'g') END"


def country_list(x: str) -> str:
    case = "CASE lower(q) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COUNTRY_NAMES.items()) + " ELSE q END"
    last = f"list_transform(list_filter(string_split({x}, ';'), lambda p: contains(p, ',')), lambda p: {strip('''string_split(p, ',')[-1]''')})"
    return f"coalesce(list_sort(list_distinct(list_transform(list_filter({last}, lambda q: q <> ''), lambda q: {case}))), [])"


def year(x: str) -> str:
    return f"CASE WHEN {x} BETWEEN 1900 AND 2030 THEN {x} END"


def keywords(x: str) -> str:
    return rf"CASE WHEN {blank(x)} THEN '' ELSE regexp_replace({strip(rf'''regexp_replace(regexp_replace(translate({x}, '|,', ';;'), ';\s*;', ';', 'g'), '\s*;\s*', '; ', 'g')''')}, ';+$', '') END"


def turned(x: str) -> str:
    words = r"string_split(regexp_replace(p, '\s+', ' ', 'g'), ' ')"
    one = f"CASE WHEN contains(p, ',') OR len({words}) < 2 THEN p ELSE concat({words}[-1], ', ', array_to_string({words}[:-2], ' ')) END"
    return f"CASE WHEN {blank(x)} THEN {x} ELSE array_to_string(list_transform({parts(x)}, lambda p: {one}), '; ') END"


def accession(ut: str, di: str, ti: str) -> str:
    code = f"printf('%06d', ('0x' || substr(md5(substr(coalesce({ti}, ''), 1, 20)), 1, 8))::BIGINT % 100000)"
    return f"CASE WHEN NOT {blank(ut)} THEN {ut} WHEN coalesce({di}, '') <> '' THEN concat('WOS:', substr(replace({di}, '/', '_'), 1, 50)) ELSE concat('WOS:GEN', {code}) END"


KEPT = "kept AS (SELECT * FROM bib_records WHERE record_id NOT IN (SELECT record_id FROM duplicate_mappings WHERE duplicate_of IS NOT NULL AND trim(duplicate_of) <> '' AND duplicate_of <> record_id))"
_TEXTS = "ti ab so au af de id c1".split()


def cleaned(src: str = "bib_records", name: str = "cleaned") -> str:
    """A CTE with the cleaned records."""
    e = {t: t for t in _TAGS}
    for t in _TEXTS:
        e[t] = dashes(t)
    e["py"] = year("py")
    e["au"] = authors(dashes("au"))
    e["di"] = doi("di")
    for t in ("de", "id"):
        e[t] = semicolons(dashes(t))
    e["cr"] = semicolons("cr")
    sel = ", ".join(f"{x} AS {t}" if t in ("py", "tc") else f"coalesce({x}, '') AS {t}" for t, x in e.items())
    return f"{name} AS (SELECT * FROM (SELECT idx, record_id, source_file, {sel}, array_to_string({country_list(dashes('c1'))}, '; ') AS sc FROM {src}) WHERE NOT (ti = '' AND au = '' AND so = ''))"


def compat(src: str = "cleaned", name: str = "compat") -> str:
    return f"""{name} AS (SELECT * REPLACE (CASE WHEN coalesce(pt, '') = '' THEN 'J' ELSE pt END AS pt, CASE WHEN coalesce(la, '') = '' THEN 'English' ELSE la END AS la,
      CASE WHEN coalesce(dt, '') = '' THEN 'Article' ELSE dt END AS dt, {turned('au')} AS au, {keywords('de')} AS de, {keywords('id')} AS id, coalesce(py, 0) AS py,
      {accession('ut', 'di', 'ti')} AS ut, coalesce({strip('di')}, '') AS di) FROM {src})"""


def issues(src: str = "bib_records") -> str:
    q = []
    base = f"SELECT record_id, '{{f}}' AS field, '{{k}}' AS issue_type, '{{s}}' AS severity, {{d}} AS description, source_file FROM {src} WHERE {{w}}"
    for t in VALID_MANDATORY:
        q.append(base.format(f=t, k="missing_value", s="high", d=f"'Mandatory field ''{t}'' is empty'", w=blank(t)))
    q.append(base.format(f="PY", k="invalid_value", s="medium", d="concat('Year ', py, ' out of typical range')", w="py IS NOT NULL AND py NOT BETWEEN 1900 AND 2030"))
    q.append(base.format(f="DI", k="invalid_format", s="medium", d="concat('DOI format suspicious: ', substr(di, 1, 50))", w=f"NOT {blank('di')} AND NOT regexp_matches(di, '^10\\.\\d{{4,}}/')"))
    n = f"length({strip('ti')})"
    q.append(base.format(f="TI", k="short_title", s="low", d=f"concat('Title suspiciously short (', {n}, ' chars)')", w=f"{n} < 10"))
    q.append(base.format(f="TI", k="long_title", s="low", d="concat('Title unusually long (', length(ti), ' chars)')", w=f"{n} >= 10 AND length(ti) > 500"))
    q.append(base.format(f="AU", k="empty_authors", s="high", d="'No authors parsed'", w=f"len({parts('au')}) = 0"))
    for t in VALID_RECOMMENDED:
        q.append(base.format(f=t, k="missing_recommended", s="low", d=f"'Recommended field ''{t}'' is empty'", w=blank(t)))
    return " UNION ALL ".join(q)


def exact(key: str, kind: str) -> str:
    return f"""SELECT idx, keep, '{kind}' AS match_type, 100.0::DOUBLE AS similarity_score FROM (
  SELECT idx, min(idx) OVER (PARTITION BY {key}) AS keep FROM bib_records WHERE {filled(key)}) WHERE idx <> keep"""


def common(x: str, y: str) -> str:
    """Length of the longest common subsequence.

    A fold over the characters of ``y``: the k-th entry of the state is the smallest place in ``x`` at which a common
    subsequence of k characters can end; a character moves it to its next place behind the entry before.
    """
    before = "(CASE WHEN k = 1 THEN 0 ELSE s[k - 1] END)"
    after = f"nullif(instr(substr({x}, {before} + 1), chr(c[1]::INT)), 0) + {before}"
    step = f"list_filter(list_transform(range(1, len(s) + 2), lambda k: least(coalesce(s[k], 1000000000), coalesce({after}, 1000000000))), lambda p: p < 1000000000)"
    return f"len(list_reduce(list_transform(string_split({y}, ''), lambda q: [unicode(q)::BIGINT]), lambda s, c: {step}, []::BIGINT[]))"


def alike(x: str, y: str) -> str:
    return f"(CASE WHEN {x} = {y} THEN 100.0::DOUBLE WHEN {x} = '' OR {y} = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {common(x, y)} / (length({x}) + length({y})) END)"


_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "


def similar(kind: str, src: str, p: str) -> str:
    """CTEs of a similarity phase over ``src``: {p}pairs (block, i, j, score) and {p}found (idx, keep, score)."""
    t = title("coalesce(ti, 'nan')")
    if kind == "title":
        texts = ["t"]
        nodes = f"SELECT substr(t, 1, 4) AS block, idx, t FROM (SELECT idx, {t} AS t FROM {src}) WHERE length(t) > 5"
        first = f"200 * least(length(a.t), length(b.t)) >= 90 * (length(a.t) + length(b.t)) AND 200 * list_sum(list_transform(range(1, {len(_ALPHABET) + 1}), lambda k: least(a.bag[k], b.bag[k]))) >= 90 * (length(a.t) + length(b.t))"
        score = f"SELECT block, i, j, {alike('ta', 'tb')} AS score FROM {p}cand"
        bag = f", list_transform(string_split('{_ALPHABET}', ''), lambda c: length(t) - length(replace(t, c, ''))) AS bag"
    else:
        texts = ["au", "t"]
        au = f"lower({strip('au')})"
        head = f"substr({strip(f'split_part({au}, chr(59), 1)')}, 1, 20)"
        nodes = f"SELECT concat(py, '|', {head}) AS block, idx, {au} AS au, {t} AS t FROM {src} WHERE py IS NOT NULL AND {au} IS NOT NULL AND {au} NOT IN ('', 'nan') AND {head} <> ''"
        first = "200 * least(length(a.au), length(b.au)) >= 85 * (length(a.au) + length(b.au))"
        score = f"SELECT block, i, j, (sa + {alike('ta', 'tb')}) / 2 AS score FROM (SELECT *, {alike('aua', 'aub')} AS sa FROM {p}cand) WHERE sa >= 85"
        bag = ""
    both = ", ".join(f"a.{x} AS {x}a, b.{x} AS {x}b" for x in texts)
    keys = ", ".join(["block", *texts])
    return f"""{p}nodes AS MATERIALIZED ({nodes}),
{p}first AS MATERIALIZED (SELECT *{bag} FROM (SELECT {keys}, min(idx) AS idx FROM {p}nodes GROUP BY ALL)),
{p}cand AS MATERIALIZED (SELECT a.block, a.idx AS i, b.idx AS j, {both} FROM {p}first a JOIN {p}first b ON a.block = b.block AND a.idx < b.idx WHERE {first}),
{p}pairs AS MATERIALIZED (SELECT * FROM ({score}) WHERE score >= 90),
{p}later AS (SELECT block, j, list(i ORDER BY i) AS earlier FROM {p}pairs GROUP BY block, j),
{p}dups AS (SELECT block, list_reduce(list([j] || earlier ORDER BY j), lambda d, r: CASE WHEN len(list_filter(r[2:], lambda x: NOT list_contains(d, x))) > 0 THEN list_append(d, r[1]) ELSE d END, []::BIGINT[]) AS d FROM {p}later GROUP BY block),
{p}keep AS (SELECT l.j AS rep, list_min(list_filter(l.earlier, lambda x: NOT list_contains(d.d, x))) AS keep FROM {p}later l JOIN {p}dups d USING (block) WHERE list_contains(d.d, l.j)),
{p}found AS MATERIALIZED (SELECT n.idx, coalesce(k.keep, f.idx) AS keep, coalesce(q.score, 100.0) AS score
  FROM {p}nodes n JOIN {p}first f USING ({keys}) LEFT JOIN {p}keep k ON k.rep = f.idx LEFT JOIN {p}pairs q ON q.i = k.keep AND q.j = k.rep WHERE n.idx <> coalesce(k.keep, f.idx))"""


def phases() -> str:
    """CTEs of all four phases; ``every`` has what they find."""
    return f"""d1 AS ({exact('di', 'doi_exact')}), d2 AS (SELECT * FROM ({exact('ut', 'ut_exact')}) WHERE idx NOT IN (SELECT idx FROM d1)),
r3 AS MATERIALIZED (SELECT * FROM bib_records WHERE idx NOT IN (SELECT idx FROM d1) AND idx NOT IN (SELECT idx FROM d2)), {similar('title', 'r3', 't_')},
r4 AS MATERIALIZED (SELECT * FROM r3 WHERE idx NOT IN (SELECT idx FROM t_found)), {similar('author', 'r4', 'a_')},
every AS (SELECT idx, keep, match_type, similarity_score FROM d1 UNION ALL SELECT idx, keep, match_type, similarity_score FROM d2
  UNION ALL SELECT idx, keep, 'title_similarity', score FROM t_found UNION ALL SELECT idx, keep, 'author_year_title', score FROM a_found)"""


def empty(x: str) -> str:
    return f"count(*) FILTER ({x} IS NULL OR cast({x} AS varchar) = '')"


def profile(fields: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{f.upper()}' AS field, count(*) AS total, {empty(f)} AS empty FROM bib_records" for f in fields)


def field_results() -> str:
    """Mandatory tags, then mapped source columns, of the tagged table."""
    have = [t for t in TAGS if t.lower() in _TAGS]
    rows = [(t, t) for t in MANDATORY] + [(t, t) for t in have]
    one = "SELECT '{s}' AS source_field, '{t}' AS target_field, count(*) - {e} AS mapped_records, {e} AS missing_records, floor((2000 * ({e}) + count(*)) // (2 * count(*))) / 10.0::DOUBLE AS null_percentage, CASE WHEN ({e})::DOUBLE / count(*) * 100 < 10 THEN 'PASS' ELSE 'WARNING' END AS status FROM bib_records"
    return " UNION ALL ".join(one.format(s=s, t=t, e=empty(t.lower())) for s, t in rows)


def measure(table: str, cols: dict[str, list[str]]) -> dict[str, str]:
    out = {"Record Count": f"(SELECT count(*) FROM {table})"}
    for n, cs in cols.items():
        cs = [c.lower() for c in cs if c.lower() in _TAGS]
        if n == "Journal Count":
            out[n] = f"(SELECT count(DISTINCT {strip('so')}) FROM {table} WHERE {filled('so')})"
        else:
            out[n] = f"(SELECT count(*) FROM {table} WHERE " + " OR ".join(f"NOT {blank(c)}" for c in cs) + ")"
    return out


def preservation() -> str:
    a, b = measure("bib_records", GROUPS), measure("cleaned", GROUPS)
    rows = [
        f"SELECT '{n}' AS metric, {a[n]} AS o, {b[n]} AS n" for n in a
    ]
    years = "(SELECT concat(min(py)::INT, '-', max(py)::INT) FROM {t})"
    o, n = years.format(t="bib_records"), years.format(t="cleaned")
    return f"""SELECT metric, o::VARCHAR AS original_value, n::VARCHAR AS normalized_value, (n - o)::VARCHAR AS difference,
  CASE WHEN abs(n - o) > 0.05 * (SELECT count(*) FROM bib_records) THEN 'Unexpected' WHEN n <> o THEN 'Configuration Driven' ELSE 'Expected' END AS classification FROM ({' UNION ALL '.join(rows)})
UNION ALL SELECT 'Publication Year Range', {o}, {n}, CASE WHEN {o} = {n} THEN '0' ELSE concat({o}, ' -> ', {n}) END, CASE WHEN {o} = {n} THEN 'Expected' ELSE 'Configuration Driven' END"""


def lines() -> str:
    """Tagged text, line by line."""
    flat = {t: f"coalesce({strip(rf'''regexp_replace(cast({t} AS varchar), '[\r\n]+', ' ', 'g')''')}, '')" for t in _TAGS}
    for t, d in (("pt", "J"), ("la", "English"), ("dt", "Article")):
        flat[t] = f"CASE WHEN coalesce({t}, '') = '' THEN '{d}' ELSE {flat[t]} END"
    flat["c1"] = f"CASE WHEN {flat['c1']} = '' AND {flat['af']} <> '' THEN concat('[Unknown] ', {flat['af']}) ELSE {flat['c1']} END"
    flat["rp"] = f"CASE WHEN {flat['rp']} = '' AND {flat['af']} <> '' THEN {strip('''split_part(''' + flat['af'] + ''', ';', 1)''')} ELSE {flat['rp']} END"
    seq = []
    for t in TAGS:
        if t.lower() not in flat:
            continue
        v, lead = f"f_{t.lower()}", "PT " if t == "PT" else f"{t}  "
        one = f"[concat('{lead}', {v})]"
        if t in WRAPPED:
            one = f"CASE WHEN length({v}) > 80 THEN list_transform(range(0, (length({v}) + 79) // 80), lambda k: concat(CASE WHEN k = 0 THEN '{lead}' ELSE '   ' END, substr({v}, k * 80 + 1, 80))) ELSE {one} END"
        if t not in TEXT_ALWAYS:
            one = f"CASE WHEN {v} = '' THEN [] ELSE {one} END"
        seq.append(one)
    whole = " || ".join(f"({s})" for s in seq) + " || ['ER', '']"
    base = ", ".join(f"{x} AS f_{t}" for t, x in flat.items())
    return f"SELECT idx, unnest(range(0, len(l)))::INT AS no, unnest(l) AS line FROM (SELECT idx, {whole} AS l FROM (SELECT idx, {base} FROM bib_records))"


def together(x: str) -> str:
    v = f"list_sort(list_distinct({parts(x)}))"
    return f"""WITH v AS (SELECT idx, unnest({v}) AS x FROM bib_records)
SELECT a.x AS a, b.x AS b, count(*) AS n FROM v a JOIN v b ON a.idx = b.idx AND a.x < b.x GROUP BY ALL"""


def layer1() -> str:
    need = "PT AU TI SO PY DT UT".split()
    pct = {t: f"count(*) FILTER ({filled(t.lower())})::DOUBLE / count(*) * 100" for t in need}
    rows = ["SELECT 'record_count' AS \"check\", CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*)::DOUBLE AS value FROM compat", "SELECT 'mandatory_columns', 'PASS', 7.0", "SELECT 'recommended_columns', 'PASS', 10.0"]
    rows += [f"SELECT 'filled_{t}', CASE WHEN {p} < 50 THEN 'WARNING' ELSE 'PASS' END, floor((2000 * count(*) FILTER ({filled(t.lower())}) + count(*)) // (2 * count(*))) / 10.0::DOUBLE FROM compat" for t, p in pct.items()]
    rows.append("SELECT 'overall', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, (count(*) > 0)::INT::DOUBLE FROM compat")
    return f"WITH {cleaned()}, {compat()} " + " UNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    C = f"WITH {cleaned()} "
    K = f"WITH {KEPT}, {cleaned('kept')} "
    top = "SELECT {n}, count(*) AS n FROM ({q}) WHERE {n} IS NOT NULL AND {n} <> '' GROUP BY {n} ORDER BY n DESC, {n} LIMIT 10"
    un = lambda e, n: f"SELECT unnest({e}) AS {n} FROM bib_records"
    dups = """dups AS (SELECT record_id, duplicate_of, match_type, similarity_score, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY coalesce(similarity_score, 0) DESC, duplicate_of, coalesce(match_type, ''), coalesce(source_file, '')) AS n
  FROM duplicate_mappings WHERE trim(coalesce(duplicate_of, '')) <> '' AND duplicate_of <> record_id AND record_id IN (SELECT record_id FROM bib_records)) WHERE n = 1)"""
    K = f"{K.rstrip()}, {dups} "
    counts = """SELECT (SELECT sum(n)::BIGINT FROM (SELECT count(*) AS n FROM bib_records GROUP BY source_file)) AS imported, (SELECT count(*) FROM bib_records) AS merged, (SELECT count(*) FROM bib_records) - (SELECT count(*) FROM kept) AS duplicates,
 (SELECT count(*) FROM kept) AS after_dedup, (SELECT count(*) FROM cleaned) AS after_cleaning, (SELECT count(*) FROM kept) AS included, (SELECT count(*) FROM dups) AS excluded"""
    sync = """SELECT *, only_validated = 0 AND only_included = 0 AS synchronized FROM (SELECT (SELECT count(*) FROM cleaned) AS validated, (SELECT count(*) FROM kept) AS included,
 (SELECT count(*) FROM cleaned WHERE record_id NOT IN (SELECT record_id FROM kept)) AS only_validated, (SELECT count(*) FROM kept WHERE record_id NOT IN (SELECT record_id FROM cleaned)) AS only_included)"""
    quality = f"""{K}, i AS ({issues('kept')}), c AS ({counts}), s AS ({sync}), q AS (
SELECT greatest(100 - CASE WHEN imported = 0 THEN 25 ELSE 0 END - CASE WHEN merged = 0 THEN 25 ELSE 0 END - CASE WHEN after_cleaning = 0 THEN 20 ELSE 0 END - CASE WHEN validated = 0 THEN 25 ELSE 0 END
 - CASE WHEN synchronized THEN 0 ELSE 20 END - CASE WHEN validated <> s.included THEN 15 ELSE 0 END, 0) AS overall_score, CASE WHEN (SELECT count(*) FROM i) < after_dedup * 0.5 THEN 'PASS' ELSE 'WARNING' END AS metadata_status FROM c, s)
SELECT overall_score, metadata_status, CASE WHEN overall_score >= 90 THEN 'A' WHEN overall_score >= 75 THEN 'B' WHEN overall_score >= 60 THEN 'C' WHEN overall_score >= 40 THEN 'D' ELSE 'F' END AS grade FROM q"""
    dim_tags = {"TI": "title", "AU": "authors", "SO": "source_title", "PY": "pubyear", "TC": "times_cited", "UT": "publication_id"}
    dim_map = [("Title", "TI"), ("Authors", "AU"), ("Source title", "SO")]
    dim_one = "SELECT '{s}' AS source_field, '{t}' AS target_field, count(*) - {e} AS mapped_records, {e} AS missing_records, floor((2000 * ({e}) + count(*)) // (2 * count(*))) / 10.0::DOUBLE AS null_percentage, CASE WHEN ({e})::DOUBLE / count(*) * 100 < 10 THEN 'PASS' ELSE 'WARNING' END AS status FROM dimensions_rows"
    dim_rows = [dim_one.format(s=t, t=t, e=empty(dim_tags[t])) for t in MANDATORY if t in dim_tags] + [dim_one.format(s=s, t=t, e=empty(dim_tags[t])) for s, t in dim_map]
    dim_targets = set(DIMENSIONS_TAGS)
    dim_rows += [
        f"SELECT 'N/A', '{t}', 0, count(*), 100.0, 'FAILED' FROM dimensions_rows" if t in dim_targets else f"SELECT 'N/A', '{t}', 0, 0, 0.0, 'NOT_AVAILABLE_FROM_SOURCE'" for t in MANDATORY if t not in dim_tags
    ]
    changed = " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS field, 'normalised' AS action_type, count(*) AS actions FROM bib_records b JOIN cleaned c USING (idx) WHERE coalesce(b.{t}, '') <> c.{t} HAVING count(*) > 0" for t in [*_TEXTS, "di"]
    )
    scores = f"""{C}, f AS ({field_results()}), k AS ({preservation()}),
a AS (SELECT count(*) FILTER (target_field IN ({', '.join(f"'{t}'" for t in MANDATORY)})) AS must, count(*) FILTER (target_field IN ({', '.join(f"'{t}'" for t in MANDATORY)}) AND status = 'PASS') AS met, avg(1 - null_percentage / 100) AS populated,
  count(*) FILTER (status = 'PASS') AS passed, count(*) AS n, count(*) FILTER (source_field = target_field AND status = 'WARNING' AND target_field IN ({', '.join(f"'{t}'" for t in MANDATORY)})) AS w FROM f),
u AS (SELECT count(*) FILTER (classification = 'Unexpected') AS unexpected FROM k),
s AS (SELECT round(met / must * 100, 1) AS cov, w + unexpected AS warnings, * FROM a, u)
SELECT cov AS field_coverage_score, round(cov * 0.3 + populated * 25 + passed / n * 20 + greatest(100 - least(warnings * 5.0, 40), 0) * 0.15 + greatest(100 - least(unexpected * 20.0, 80), 0) * 0.1, 1) AS mapping_quality_score,
 CASE WHEN unexpected > 0 THEN 'FAILED' WHEN warnings > 0 THEN 'WARNING' WHEN cov >= 95 THEN 'PASS' ELSE 'PASS_WITH_INFORMATION' END AS overall_status, CASE WHEN cov >= 100 THEN 'EXCELLENT' WHEN cov >= 95 THEN 'GOOD' WHEN cov >= 90 THEN 'ACCEPTABLE' ELSE 'NEEDS_REVIEW' END AS coverage_class FROM s"""
    groups = "SELECT printf('Group_%03d_%s', dense_rank() OVER (ORDER BY source_database), replace(source_database, ' ', '_')) AS group_id, source_database, count(*) AS files FROM source_files GROUP BY source_database"
    flag = f"""WITH l AS (SELECT * FROM bib_records WHERE idx NOT IN (SELECT idx FROM ({exact('di', 'doi_exact')}))), {cleaned('l')}, i AS ({issues('cleaned')}) SELECT severity, count(*) AS issues FROM i GROUP BY severity"""
    return {
        "import_counts": "SELECT source_file, count(*) AS records FROM bib_records GROUP BY source_file",
        "merge_union_by_name": 'SELECT record_id, source_file, au AS "AU", ti AS "TI", so AS "SO", py::VARCHAR AS "PY", tc::VARCHAR AS "TC", ut AS "UT", la AS "LA" FROM bib_records UNION ALL BY NAME SELECT publication_id AS record_id, \'dimensions\' AS source_file, authors AS "AU", title AS "TI", source_title AS "SO", pubyear::VARCHAR AS "PY", times_cited::VARCHAR AS "TC", publication_id AS "UT" FROM dimensions_rows',
        "provenance": "SELECT record_id, source_file, idx AS original_index, 'imported' AS transformations, 'imported' AS status FROM bib_records",
        "database_groups": groups,
        "merge_policy_pairs": f"WITH g AS ({groups}) SELECT x.group_id AS a, y.group_id AS b, x.source_database = y.source_database AS allowed, CASE WHEN x.source_database = y.source_database THEN 'ALLOWED' ELSE 'BLOCKED' END AS reason FROM g x JOIN g y ON x.group_id < y.group_id",
        "dedup_doi_exact": exact("di", "doi_exact"),
        "dedup_ut_exact": exact("ut", "ut_exact"),
        "group_places": f"SELECT idx, row_number() OVER (PARTITION BY di ORDER BY idx)::INT AS place FROM bib_records WHERE {filled('di')}",
        "title_block_stats": f"SELECT substr(t, 1, 4) AS block, count(*) AS titles FROM (SELECT {title('''coalesce(ti, 'nan')''')} AS t FROM bib_records) WHERE length(t) > 5 GROUP BY block",
        "title_classes": f"SELECT idx, min(idx) OVER (PARTITION BY t) AS representative FROM (SELECT idx, {title('''coalesce(ti, 'nan')''')} AS t FROM bib_records) WHERE length(t) > 5",
        "title_similarity_pairs": f"WITH {similar('title', 'bib_records', 't_')} SELECT i, j, round(score, 6) AS score FROM t_pairs",
        "dedup_title_similarity": f"WITH {similar('title', 'bib_records', 't_')} SELECT idx, keep, round(score, 6) AS score FROM t_found",
        "dedup_author_year": f"WITH {similar('author', 'bib_records', 'a_')} SELECT idx, keep, round(score, 6) AS score FROM a_found",
        "dedup_mappings": f"WITH {phases()} SELECT b.record_id, k.record_id AS duplicate_of, match_type, round(similarity_score, 6) AS similarity_score, b.source_file FROM every JOIN bib_records b USING (idx) JOIN bib_records k ON k.idx = every.keep",
        "dedup_summary": f"WITH {phases()} SELECT match_type, count(*) AS n FROM every GROUP BY match_type",
        "mapping_summary": "SELECT lower(match_type) AS match_type, count(*) AS n FROM duplicate_mappings WHERE match_type IS NOT NULL GROUP BY 1",
        "validation_issues": issues(),
        "issues_by_severity": f"SELECT severity, count(*) AS issues FROM ({issues()}) GROUP BY severity",
        "issues_by_field": f"SELECT field, issue_type, count(*) AS issues FROM ({issues()}) GROUP BY ALL",
        "clean_doi": f"SELECT idx, {doi('di')} AS di FROM bib_records",
        "clean_keywords": f"SELECT idx, {semicolons('de')} AS de FROM bib_records",
        "clean_authors": f"SELECT idx, {authors('au')} AS au FROM bib_records",
        "clean_years": f"SELECT idx, {year('py')} AS py FROM bib_records",
        "normal_titles": f"SELECT idx, {title('ti')} AS title FROM bib_records",
        "fixed_dashes": f"SELECT idx, {dashes('ti')} AS ti FROM bib_records",
        "squeezed_text": rf"SELECT idx, {strip(r'''regexp_replace(ti, '[\s\p{Z}\x{0B}\x{85}]+', ' ', 'g')''')} AS ti FROM bib_records",
        "countries": f"SELECT idx, array_to_string({country_list('c1')}, '; ') AS countries FROM bib_records",
        "cleaned_records": f"{C} SELECT idx, ti, au, so, py, di, de, id, cr, c1, sc, af FROM cleaned",
        "cleaning_actions": f"{C} {changed}",
        "country_counts": f"SELECT country, count(*) AS n FROM ({un(country_list('c1'), 'country')}) GROUP BY country",
        "keyword_counts": f"SELECT keyword, count(*) AS n FROM ({un(parts('de'), 'keyword')}) GROUP BY keyword",
        "journal_counts": f"SELECT so AS journal, count(*) AS n FROM bib_records WHERE NOT {blank('so')} GROUP BY so",
        "compat_records": f"WITH {cleaned()}, {compat()} SELECT idx, pt, au, la, dt, de, id, py, ut, di FROM compat",
        "generated_ut": f"SELECT idx, {accession('ut', 'di', 'ti')} AS ut FROM bib_records",
        "author_format": f"SELECT idx, {turned('au')} AS au FROM bib_records",
        "field_profile": profile(_TAGS),
        "mapping_field_results": field_results(),
        "mapping_field_results_dimensions": " UNION ALL ".join(dim_rows),
        "metadata_preservation": f"{C} {preservation()}",
        "coverage_and_quality": scores,
        "layer1_checks": layer1(),
        "author_format_sample": "WITH s AS (SELECT au FROM (SELECT au FROM bib_records ORDER BY idx LIMIT 50) WHERE au IS NOT NULL) SELECT count(*) AS sampled, count(*) FILTER (contains(au, ',')) AS with_comma, CASE WHEN count(*) FILTER (contains(au, ',')) > 0.5 * count(*) THEN 'PASS' ELSE 'WARNING' END AS status FROM s",
        "year_range": "SELECT min(py) AS first_year, max(py) AS last_year, count(py) AS valid_years, CASE WHEN min(py) >= 1900 AND max(py) <= 2030 THEN 'PASS' ELSE 'WARNING' END AS status FROM bib_records",
        "doi_coverage": " UNION ALL ".join(f"SELECT '{t.upper()}' AS field, count(*) FILTER ({filled(t)}) AS present, floor((2000 * count(*) FILTER ({filled(t)}) + count(*)) // (2 * count(*))) / 10.0::DOUBLE AS percentage FROM bib_records" for t in ("di", "ab")),
        "screening_log": f"{K} SELECT record_id, substr(coalesce(ti, ''), 1, 100) AS title, source_file, 'included' AS decision, 'Passed all validation criteria' AS reason FROM kept UNION ALL SELECT record_id, 'Duplicate - excluded', source_file, 'excluded', concat('Duplicate of ', duplicate_of, ' (', coalesce(match_type, 'None'), ', score=', printf('%.1f', coalesce(similarity_score, 0.0)), ')') FROM dups",
        "excluded_studies": f"{K} SELECT record_id, concat('Duplicate (', coalesce(match_type, 'None'), ')') AS excluded_reason, duplicate_of, similarity_score, source_file FROM dups",
        "prisma_counts": f"{K} {counts}",
        "flow_by_file": f"{K} SELECT source_file, count(*) AS imported, count(k.idx) AS after_dedup, count(c.idx) AS after_cleaning FROM bib_records b LEFT JOIN (SELECT idx FROM kept) k USING (idx) LEFT JOIN (SELECT idx FROM cleaned) c USING (idx) GROUP BY source_file",
        "sync_check": f"{K} {sync}",
        "database_group_records": f"SELECT printf('Group_%03d_%s', dense_rank() OVER (ORDER BY source_database), replace(source_database, ' ', '_')) AS group_id, source_database, count(*) AS files, string_agg(source_file, ', ' ORDER BY source_file) AS file_names, coalesce(sum(n), 0)::BIGINT AS total_records FROM source_files LEFT JOIN (SELECT source_file, count(*) AS n FROM bib_records GROUP BY source_file) USING (source_file) GROUP BY source_database",
        "detect_database": """SELECT table_name, CASE WHEN count(*) FILTER (column_name IN ('publication_id')) > 0 THEN 'Dimensions' WHEN count(*) FILTER (column_name IN ('au', 'ti', 'so', 'py', 'dt', 'de', 'cr', 'ut')) >= 3 THEN 'Web of Science' ELSE 'Unknown' END AS detected,
 (CASE table_name WHEN 'bib_records' THEN count(*) - 4 ELSE count(*) END)::INT AS columns FROM information_schema.columns WHERE table_name IN ('bib_records', 'dimensions_rows', 'documents') GROUP BY table_name""",
        "stream_arrivals": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
        "stream_accepted": f"SELECT idx FROM (SELECT *, CASE WHEN {filled('ut')} THEN row_number() OVER (PARTITION BY ut ORDER BY idx) ELSE 1 END AS m FROM (SELECT *, CASE WHEN {filled('di')} THEN row_number() OVER (PARTITION BY di ORDER BY idx) ELSE 1 END AS n FROM bib_records) WHERE n = 1) WHERE m = 1",
        "quality_score": quality,
        "wos_text_lines": lines(),
        "wos_record_roundtrip": "SELECT count(*) AS records, count(*) AS titles, count(*) AS abstracts, count(*) AS keywords FROM bib_records",
        "biblio_analysis": f"SELECT (SELECT count(DISTINCT so) FROM bib_records WHERE {filled('so')}) AS sources, count(*) AS documents, (SELECT count(DISTINCT a) FROM ({un(parts('au'), 'a')})) AS authors, coalesce(sum(len({parts('au')})), 0) AS appearances, count(*) FILTER (len({parts('au')}) = 1) AS single_authored, round(sum(len({parts('au')})) / count(*), 6) AS coauthors_per_doc FROM bib_records",
        "top_authors": top.format(n="author", q=un(parts("au"), "author")),
        "top_sources": top.format(n="source", q="SELECT so AS source FROM bib_records"),
        "top_keywords": top.format(n="keyword", q=un(parts("de"), "keyword")),
        "top_countries": top.format(n="country", q=un(country_list("c1"), "country")),
        "annual_production": "SELECT py AS year, count(*) AS n FROM bib_records WHERE py IS NOT NULL GROUP BY py",
        "most_cited": "SELECT record_id, tc::BIGINT AS cited FROM bib_records WHERE tc IS NOT NULL ORDER BY tc DESC, record_id LIMIT 10",
        "coauthor_pairs": together("au"),
        "keyword_cooccurrence": together("de"),
        "cocitation_pairs": together("cr"),
        "reference_coupling": f"WITH v AS (SELECT idx, unnest(list_distinct({parts('cr')})) AS x FROM bib_records), n AS (SELECT x, count(*) AS n FROM v GROUP BY x) SELECT idx, count(*) AS values, sum(n - 1)::BIGINT AS links FROM v JOIN n USING (x) GROUP BY idx",
        "flagship": flag,
    }
