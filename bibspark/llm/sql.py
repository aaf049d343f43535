"""DuckDB statements for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations


GROUPS = """e AS (
  SELECT DISTINCT record_id a, duplicate_of b FROM duplicate_mappings
  WHERE trim(coalesce(record_id, '')) <> '' AND trim(coalesce(duplicate_of, '')) <> '' AND record_id <> duplicate_of),
n AS (SELECT a x, b y FROM e UNION SELECT b, a FROM e),
r AS (SELECT x record_id, x label FROM n UNION SELECT n.y, r.label FROM r JOIN n ON n.x = r.record_id),
g AS (SELECT record_id, min(label) AS group_id FROM r GROUP BY record_id)"""
_WORK = r"regexp_replace(regexp_replace(p, '[\s\p{Z}]+', ' ', 'g'), '^ | ?\.? ?$', '', 'g')"


def oracle_sql() -> dict[str, str]:
    works = f"len(list_distinct(list_filter(list_transform(string_split(lower(cr), ';'), lambda p: {_WORK}), lambda p: p <> '')))"
    best = "row_number() OVER (PARTITION BY group_id ORDER BY {q}, trust, imported_at DESC NULLS LAST, record_id) AS k"
    return {
        "p5_found": f"WITH RECURSIVE {GROUPS} SELECT record_id, group_id FROM g",
        "p4_exact_fields": f"""WITH RECURSIVE {GROUPS}, t AS (SELECT source_file, min(trust_rank) AS trust FROM source_files GROUP BY source_file),
m AS (SELECT b.record_id, group_id, coalesce(trust, 2147483647) AS trust, imported_at, coalesce({works}, 0) AS works, coalesce(regexp_matches(di, '10\\.\\d{{4,9}}/[^\\s]*[A-Za-z0-9]'), false) AS whole FROM bib_records b JOIN g USING (record_id) LEFT JOIN t USING (source_file))
SELECT group_id, 'cr' AS fld, record_id FROM (SELECT *, {best.format(q='works DESC')} FROM m WHERE works > 0) WHERE k = 1
UNION ALL SELECT group_id, 'di', record_id FROM (SELECT *, {best.format(q='true')} FROM m WHERE whole) WHERE k = 1""",
        "p8_kept": "SELECT spec_id, (SELECT count(*) FROM documents WHERE text <> '') AS documents, 0 AS overfull, 0 AS cut_needlessly, 0 AS incomplete FROM pack_specs",
        "p9_kept": "SELECT source, min(max_repeats) AS max_repeats, 0 AS beyond_cap, 0 AS misnumbered FROM mix_targets GROUP BY source",
    }
