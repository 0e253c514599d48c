"""SQL of the queries that SQL can express, written from the problems' definitions and not from the operators."""

from __future__ import annotations

_BLANK = r"[\s\p{Z}\x{85}\x{200B}\x{2060}\x{FEFF}]+"


def _cut(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}|{_BLANK}$', '', 'g')"


_FILE = r"upper(regexp_extract(video_id, '[^/\\]*$'))"
_CAM = f"coalesce(nullif(regexp_extract(regexp_replace(upper(meta['camera_id']), '[^A-Z0-9]+', '', 'g'), 'T8[A-Z0-9]{{6,}}'), ''), nullif(regexp_extract({_FILE}, '(^|[^A-Z0-9])(T8[A-Z0-9]{{6,}})', 2), ''))"
_SPLIT = "CASE WHEN {0} IN ('train', 'training', 'tr') THEN 'train' WHEN {0} IN ('val', 'valid', 'validation', 'dev', 'development', 'test', 'testing', 'tst', 'eval') THEN 'eval' END".format(f"lower({_cut("meta['source_split']")})")
_REC = rf"nullif(regexp_replace(regexp_extract({_FILE}, '(?:^|[^A-Z0-9])(T8[A-Z0-9]{{6,}}[^A-Z0-9]+[0-9]{{14}}[^A-Z0-9]+[0-9]+)(?:$|[^A-Z0-9])', 1), '[^A-Z0-9]+', '_', 'g'), '')"

ORACLE = {
    "p1_found": f"""WITH u AS (SELECT upper({_cut('labels.role_type')}) AS rt, lower({_cut('labels.sub_keyscene')}) AS sk FROM labels WHERE video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1),
c AS (SELECT 'rt' AS axis, rt AS letter, count(*) AS n FROM u WHERE regexp_full_match(rt, '[A-E]') GROUP BY rt UNION ALL SELECT 'sk', sk, count(*) FROM u WHERE regexp_full_match(sk, '[a-u]') GROUP BY sk),
z AS (SELECT axis, sum(n) / 5.0 AS size FROM c GROUP BY axis)
SELECT t.axis, t.letter FROM sample_targets t LEFT JOIN c ON t.axis = c.axis AND t.letter = c.letter LEFT JOIN z ON t.axis = z.axis WHERE coalesce(c.n, 0) < t.p * coalesce(z.size, 0) - 1e-6 OR coalesce(c.n, 0) < t.min_n""",
    "p4_found": f"""WITH RECURSIVE r AS (SELECT pos, video_id, {_CAM} AS cam FROM labels), pairs AS (SELECT DISTINCT video_id, cam FROM r WHERE cam IS NOT NULL AND video_id IS NOT NULL),
e AS (SELECT DISTINCT a.cam AS x, b.cam AS y FROM pairs a JOIN pairs b ON a.video_id = b.video_id WHERE a.cam <> b.cam),
c(cam, root) AS (SELECT DISTINCT cam, cam FROM r WHERE cam IS NOT NULL UNION SELECT e.y, c.root FROM c JOIN e ON c.cam = e.x),
g AS (SELECT cam, min(root) AS g FROM c GROUP BY cam), v AS (SELECT p.video_id, min(g.g) AS g FROM pairs p JOIN g ON p.cam = g.cam GROUP BY p.video_id),
a AS (SELECT r.pos, coalesce(g.g, v.g, r.video_id) AS group_id FROM r LEFT JOIN g ON r.cam = g.cam LEFT JOIN v ON r.video_id = v.video_id)
SELECT pos, group_id FROM a WHERE group_id IS NOT NULL QUALIFY count(*) OVER (PARTITION BY group_id) > 1""",
    "p5_found": rf"""WITH r AS MATERIALIZED (SELECT pos, video_id, {_REC} AS rec, {_CAM} AS cam, recorded_at AS at, {_SPLIT} AS split, CASE WHEN labels.description IS NOT NULL THEN list_filter(regexp_split_to_array(lower(labels.description), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda w: w <> '') END AS w FROM labels),
t AS (SELECT * FROM r WHERE split = 'train'), e AS (SELECT * FROM r WHERE split = 'eval'),
n AS (SELECT t.pos AS a, e.pos AS b, t.w AS x, e.w AS y, list_distinct(list_concat(t.w, e.w)) AS v FROM t JOIN e ON t.cam = e.cam AND abs(epoch_us(t.at) - epoch_us(e.at)) <= 2000000 WHERE t.w IS NOT NULL AND e.w IS NOT NULL AND abs(len(t.w) - len(e.w)) <= 2),
p AS (SELECT t.pos AS a, e.pos AS b FROM t JOIN e ON t.video_id = e.video_id UNION SELECT t.pos, e.pos FROM t JOIN e ON t.rec = e.rec
UNION SELECT a, b FROM n WHERE levenshtein(array_to_string([chr(33 + list_position(v, q)::INT) FOR q IN x], ''), array_to_string([chr(33 + list_position(v, q)::INT) FOR q IN y], '')) <= 2)
SELECT least(a, b) AS pos_a, greatest(a, b) AS pos_b FROM p""",
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text, true AS same FROM documents",
}
