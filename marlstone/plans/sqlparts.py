"""SQL that several oracles share: white space as Python cuts it, rows that count, and strictly parsed outputs."""

from marlstone import vocab

WS = f"[{vocab.WHITE}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{WS}+'), lambda w: w <> '')"


def share(a: str, b: str) -> str:
    return f"round(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END, 6)"


#: The last row of each video in labels and in eval_preds, and the last prediction.
GOLD = "gold AS (SELECT video_id, pos, labels.role_type AS grt, labels.sub_keyscene AS gsk, labels.description AS gdesc, meta FROM labels QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1)"
LAST = "last AS (SELECT video_id, pos, output, score FROM eval_preds QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1)"


def strict(source: str) -> str:
    """CTEs that end in ``strict``: the rows of ``source`` with r, k, d, n, leak, fixed, ok, legal by position."""
    bad = " OR ".join(f"(r = '{r}' AND contains('{s}', k))" for r, s in vocab.ILLEGAL.items())
    return f"""cut AS (SELECT *, string_split({strip("string_split(output, '</think>')[-1]")}, '|') AS s, coalesce(contains(output, '<think>') OR contains(output, '</think>'), false) AS leak FROM {source}),
tok AS (SELECT *, CASE WHEN output IS NULL THEN 0 ELSE len(s) END AS n, {strip("s[1]")} AS a, {strip("s[2]")} AS b, {strip(f"array_to_string([{strip('x')} FOR x IN s[3:]], '|')")} AS d FROM cut),
cased AS (SELECT *, CASE WHEN length(a) = 1 THEN upper(a) ELSE a END AS r, CASE WHEN length(b) = 1 THEN lower(b) ELSE b END AS k FROM tok),
strict AS (SELECT *, n >= 3 AND coalesce(r <> a OR k <> b, false) AS fixed, n >= 3 AND coalesce(regexp_full_match(r, '[A-E]') AND regexp_full_match(k, '[a-u]'), false) AS ok,
  NOT coalesce(n >= 3 AND regexp_full_match(r, '[A-E]') AND regexp_full_match(k, '[a-u]') AND ({bad}), false) AS legal FROM cased)"""


def group(x: str, unknown: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {x} IN ({', '.join(repr(c) for c in s)}) THEN '{g}'" for g, s in vocab.GROUPS.items()) + f" ELSE {unknown} END"


def letters(s: str) -> str:
    return ", ".join(f"'{c}'" for c in s)


SPLIT = """CASE WHEN lower(regexp_replace({0}, '^[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+|[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+$', '', 'g')) IN ('train', 'training', 'tr') THEN 'train'
WHEN lower(regexp_replace({0}, '^[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+|[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+$', '', 'g')) IN ('val', 'valid', 'validation', 'dev', 'development') THEN 'val'
WHEN lower(regexp_replace({0}, '^[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+|[\\s\\p{{Z}}\\x{{85}}\\x{{200B}}\\x{{2060}}\\x{{FEFF}}]+$', '', 'g')) IN ('test', 'testing', 'tst', 'eval') THEN 'test' END"""


def split(x: str) -> str:
    return SPLIT.format(x)
