"""DuckDB SQL text for the correctness oracle.

Every Spark query registered in ``__spark_entry__`` has an independent formulation here in
plain DuckDB SQL over the same Parquet tables (registered as views by the checker).  The
helpers below only assemble SQL strings; nothing here imports DuckDB or runs Spark.
"""

from __future__ import annotations

from pairforge import constants as C

# Python str.isspace() code points, spelled out for RE2 (whose \s is ASCII-only).
WS = r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lstrip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+', '')"


def ensure_prefix(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN starts_with({s}, 'Assistant:') THEN {s} ELSE 'Assistant: ' || {s} END)"


def strip_prefix(x: str) -> str:
    return f"(CASE WHEN starts_with({x}, 'Assistant:') THEN {lstrip(f'substr({x}, 11)')} ELSE {x} END)"


def prompt(instr: str, inp: str) -> str:
    return f"('Human: ' || {instr} || ' ' || coalesce({inp}, '') || ' ')"


def user_text(instr: str, inp: str) -> str:
    return f"(CASE WHEN coalesce({inp}, '') <> '' THEN {instr} || {q(C.INPUT_JOIN)} || {inp} ELSE {instr} END)"


def candidate_block(resp: str) -> str:
    return (
        f"array_to_string(list_transform({resp}, lambda x, i: '\n\n[' || CAST(i AS VARCHAR) || ']\n' || x), '')"
    )


def rank_prompt(system: str, instr: str, inp: str, resp_block: str) -> str:
    return (
        f"({q(system + chr(10) + chr(10) + C.INSTRUCTION_HEADER)} || {user_text(instr, inp)} || "
        f"{q(chr(10) + chr(10) + C.CANDIDATES_HEADER)} || {resp_block} || {q(chr(10) + C.RETURN_JSON)})"
    )


def best_worst_prompt(p: str) -> str:
    for old, new in C.BEST_WORST_REPLACEMENTS:
        p = f"replace({p}, {q(old)}, {q(new)})"
    return p


# ---- examples / responses views ----------------------------------------------------------

EXAMPLES_CTE = """
_sys AS (
  SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations WHERE role = 'system' GROUP BY conv_id
),
_ex0 AS (
  SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(s.system_text, '') AS input, a.text AS output
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN _sys s ON s.conv_id = u.conv_id
  WHERE u.role = 'user'
),
examples AS (
  SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS example_id,
         conv_id, turn, instruction, input, output
  FROM _ex0
)"""

RESPONSES_CTE = EXAMPLES_CTE + f""",
_n AS (SELECT count(*) AS n FROM examples),
_cand AS (
  SELECT e.example_id, j.j, {ensure_prefix('s.output')} AS text
  FROM examples e CROSS JOIN range(4) j(j) CROSS JOIN _n
  JOIN examples s ON s.example_id = (e.example_id + 7 * j.j) % _n.n
),
responses AS (
  SELECT e.example_id, e.instruction, e.input, {prompt('e.instruction', 'e.input')} AS prompt,
         list(c.text ORDER BY c.j) AS responses, e.output AS reference_output
  FROM examples e JOIN _cand c ON c.example_id = e.example_id
  GROUP BY e.example_id, e.instruction, e.input, e.output
)"""


def with_ctes(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# ---- stub models --------------------------------------------------------------------------

def _lens(resp: str) -> str:
    return f"list_transform({resp}, lambda x: length(x))"


def longest(resp: str) -> str:
    return f"CAST(list_position({_lens(resp)}, list_max({_lens(resp)})) AS VARCHAR)"


def shortest(resp: str) -> str:
    return f"CAST(list_position({_lens(resp)}, list_min({_lens(resp)})) AS VARCHAR)"


def best_reply(key: str, resp: str) -> str:
    b, w = longest(resp), shortest(resp)
    return f"""(CASE ({key}) % 10
  WHEN 0 THEN '{{"best": ' || {b} || ', "reason": "most complete answer"}}'
  WHEN 1 THEN 'After reading all candidates: {{"best": ' || {b} || ', "reason": "clearest"}} Done.'
  WHEN 2 THEN '{{"best": "' || {b} || '", "reason": "quoted index"}}'
  WHEN 3 THEN '{{"best": ' || {b} || '.7, "reason": "fractional index"}}'
  WHEN 4 THEN '{{"best": 9, "reason": "out of range"}}'
  WHEN 5 THEN '{{"best": ' || {b} || '}} and {{"best": 1}}'
  WHEN 6 THEN 'I cannot decide between these responses.'
  WHEN 7 THEN '{{"best": ' || {b} || ', "worst": ' || {w} || ', "reason": "both ends"}}'
  WHEN 8 THEN '{{''best'': ' || {b} || ', ''reason'': ''single quotes''}}'
  ELSE '{{"best": 1, "best": ' || {b} || ', "reason": "second key wins"}}' END)"""


def best_worst_reply(key: str, resp: str) -> str:
    b, w = longest(resp), shortest(resp)
    return f"""(CASE ({key}) % 10
  WHEN 0 THEN '{{"best": ' || {b} || ', "worst": ' || {w} || ', "reason": "most and least complete"}}'
  WHEN 1 THEN 'Verdict: {{"best": ' || {b} || ', "worst": ' || {w} || ', "reason": "clear"}} end'
  WHEN 2 THEN '{{"best": "' || {b} || '", "worst": "' || {w} || '", "reason": "quoted"}}'
  WHEN 3 THEN '{{"best": ' || {b} || '.7, "worst": ' || {w} || '.2, "reason": "fractional"}}'
  WHEN 4 THEN '{{"best": ' || {b} || ', "worst": 9, "reason": "worst out of range"}}'
  WHEN 5 THEN '{{"best": ' || {b} || ', "worst": ' || {w} || '}} and {{"best": 1, "worst": 2}}'
  WHEN 6 THEN 'No verdict.'
  WHEN 7 THEN '{{"best": ' || {b} || ', "worst": ' || {b} || ', "reason": "same index"}}'
  WHEN 8 THEN '{{"best": ' || {b} || ', "reason": "worst missing"}}'
  ELSE '{{"best": ' || {w} || ', "worst": ' || {w} || ', "best": ' || {b} || ', "reason": "duplicate key"}}' END)"""


def teacher_reply(key: str, ref: str) -> str:
    return f"""(CASE ({key}) % 3 WHEN 0 THEN {ref}
  WHEN 1 THEN '  Assistant:  ' || {ref} || chr(10)
  ELSE 'Assistant: Assistant: ' || {ref} END)"""


def teacher_chosen(raw: str) -> str:
    return f"('Assistant: ' || {strip_prefix(strip(raw))})"


# ---- strict verdict parsing (DuckDB side) -------------------------------------------------

def span(raw: str) -> str:
    return f"regexp_extract({raw}, '\\{{.*\\}}', 0, 's')"


def field(sp: str, key: str) -> str:
    """Last occurrence of a top-level key (Python dict semantics), as JSON; NULL if absent."""
    keys = f"json_keys({sp})"
    pos = f"list_position(list_reverse({keys}), {q(key)})"
    return f"(CASE WHEN {pos} > 0 THEN json_extract({sp}, '$.*')[len({keys}) - {pos} + 1] END)"


def py_int(v: str) -> str:
    """Python int() of a JSON value (DuckDB JSON), NULL where Python raises."""
    s = strip(f"json_extract_string({v}, '$')")
    return f"""(CASE json_type({v})
  WHEN 'UBIGINT' THEN TRY_CAST({v} AS BIGINT)
  WHEN 'BIGINT' THEN TRY_CAST({v} AS BIGINT)
  WHEN 'DOUBLE' THEN TRY_CAST(trunc(CAST({v} AS DOUBLE)) AS BIGINT)
  WHEN 'BOOLEAN' THEN CASE WHEN CAST({v} AS BOOLEAN) THEN 1 ELSE 0 END
  WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+(_[0-9]+)*') THEN TRY_CAST(replace({s}, '_', '') AS BIGINT) END
  END)"""


def reason(sp: str) -> str:
    v = field(sp, "reason")
    return f"""(CASE WHEN {v} IS NULL THEN ''
  WHEN json_type({v}) = 'NULL' THEN NULL
  WHEN json_type({v}) = 'VARCHAR' THEN json_extract_string({v}, '$')
  ELSE CAST({v} AS VARCHAR) END)"""


def valid_span(sp: str) -> str:
    return f"({sp} <> '' AND json_valid({sp}))"


# ---- splits, shuffles, held-out rows -------------------------------------------------------

def md5_key(salt_seed: str, key: str) -> str:
    return f"md5({q(salt_seed)} || CAST({key} AS VARCHAR))"


def bucket(salt_seed: str, key: str, buckets: int = 10000) -> str:
    return f"((('0x' || substr({md5_key(salt_seed, key)}, 1, 8))::BIGINT) % {buckets})"


def exact_split_cte(name: str, src: str, key: str, fraction: float = 0.05, seed: int = 42) -> str:
    return f"""{name} AS (
  SELECT s.*, CASE WHEN row_number() OVER (ORDER BY {md5_key(f'{seed}:', 's.' + key)}, s.{key}) - 1
                        < ceil((SELECT count(*) FROM {src}) * {fraction!r}) THEN 'test' ELSE 'train' END AS split
  FROM {src} s)"""


PRIOR_SEED = 7
PRIOR_FRACTION = 0.34

HELDOUT_CTE = EXAMPLES_CTE + f""",
{exact_split_cte('_split', 'examples', 'example_id')},
_shuf AS (
  SELECT CAST(row_number() OVER (ORDER BY {md5_key('shuffle:42:', 'example_id')}, example_id) - 1 AS BIGINT) AS eval_id,
         example_id, instruction, input, output
  FROM _split WHERE split = 'test'
),
_prior AS (
  SELECT {prompt('instruction', 'input')} AS prompt FROM examples
  WHERE {bucket(f'prior:{PRIOR_SEED}:', 'example_id')} < {int(round(PRIOR_FRACTION * 10000))}
),
heldout AS (
  SELECT eval_id, instruction, input, {prompt('instruction', 'input')} AS prompt, output AS reference_output
  FROM _shuf WHERE {prompt('instruction', 'input')} NOT IN (SELECT prompt FROM _prior)
)"""


# ---- blind evaluation ------------------------------------------------------------------------

EVAL_CTE = HELDOUT_CTE + f""",
_sysout AS (
  SELECT eval_id, 'pretrained' AS system, {ensure_prefix('instruction')} AS text FROM heldout
  UNION ALL SELECT eval_id, 'sft', {ensure_prefix('reference_output')} FROM heldout
  UNION ALL SELECT eval_id, 'dpo', {ensure_prefix("reference_output || chr(10) || instruction")} FROM heldout
),
_lab AS (
  SELECT eval_id, system, text,
         row_number() OVER (PARTITION BY eval_id
                            ORDER BY md5('blind:' || CAST(42 + eval_id AS VARCHAR) || ':' || system), system) AS label
  FROM _sysout
),
_rk AS (SELECT *, row_number() OVER (PARTITION BY eval_id ORDER BY length(text) DESC, label) AS len_rank FROM _lab),
blind AS (
  SELECT h.eval_id, h.instruction, h.input, h.prompt,
         list(r.system ORDER BY r.label) AS label_order,
         list(r.text ORDER BY r.label) AS labelled,
         max(CASE WHEN r.system = 'pretrained' THEN r.text END) AS resp_pretrained,
         max(CASE WHEN r.system = 'sft' THEN r.text END) AS resp_sft,
         max(CASE WHEN r.system = 'dpo' THEN r.text END) AS resp_dpo,
         CAST(max(CASE WHEN r.len_rank = 1 THEN r.label END) AS VARCHAR) AS a,
         CAST(max(CASE WHEN r.len_rank = 2 THEN r.label END) AS VARCHAR) AS b,
         CAST(max(CASE WHEN r.len_rank = 3 THEN r.label END) AS VARCHAR) AS c
  FROM heldout h JOIN _rk r ON r.eval_id = h.eval_id
  GROUP BY h.eval_id, h.instruction, h.input, h.prompt
),
_jr AS (
  SELECT *, CASE eval_id % 8
    WHEN 0 THEN '{{"ranking": [' || a || ', ' || b || ', ' || c || '], "reason": "longest first"}}'
    WHEN 1 THEN 'Ranking: {{"ranking": ["' || a || '", "' || b || '", "' || c || '"], "reason": "strings"}} done'
    WHEN 2 THEN '{{"ranking": "' || a || b || c || '", "reason": "compact"}}'
    WHEN 3 THEN '{{"ranking": {{"' || a || '": 0, "' || b || '": 0, "' || c || '": 0}}, "reason": "object keys"}}'
    WHEN 4 THEN '{{"ranking": [' || a || ', ' || a || ', ' || c || '], "reason": "repeated"}}'
    WHEN 5 THEN '{{"ranking": [' || a || ', ' || b || '], "reason": "short"}}'
    WHEN 6 THEN 'The first one is best.'
    ELSE '{{"ranking": [' || a || '.0, ' || b || ', ' || c || '], "reason": "float"}}' END AS judge_raw
  FROM blind
),
_js AS (SELECT *, {span('judge_raw')} AS span FROM _jr),
_jv AS (
  SELECT *, CASE WHEN {valid_span('span')} THEN {field('span', 'ranking')} END AS rv,
            CASE WHEN {valid_span('span')} THEN {reason('span')} END AS reason
  FROM _js
),
_ji AS (
  SELECT *, CASE json_type(rv)
    WHEN 'ARRAY' THEN list_transform(json_extract(rv, '$[*]'), lambda e: {py_int('e')})
    WHEN 'VARCHAR' THEN list_transform(string_split(json_extract_string(rv, '$'), ''),
                                       lambda ch: CASE WHEN regexp_full_match(ch, '[0-9]') THEN CAST(ch AS BIGINT) END)
    WHEN 'OBJECT' THEN list_transform(json_keys(rv),
                                      lambda k: CASE WHEN regexp_full_match({strip('k')}, '[+-]?[0-9]+') THEN CAST({strip('k')} AS BIGINT) END)
    END AS items
  FROM _jv
),
parsed AS (
  SELECT *, coalesce(items IS NOT NULL AND len(list_filter(items, lambda x: x IS NULL)) = 0
                     AND list_sort(items) = [1, 2, 3], false) AS ok
  FROM _ji
),
results AS (
  SELECT eval_id, instruction, input, prompt, items AS ranking, label_order, reason AS judge_reason,
         list_position(items, list_position(label_order, 'dpo')) < list_position(items, list_position(label_order, 'sft')) AS dpo_beats_sft,
         list_position(items, list_position(label_order, 'sft')) < list_position(items, list_position(label_order, 'pretrained')) AS sft_beats_pretrained,
         label_order[items[1]] AS best_model,
         list_transform(items, lambda l: label_order[l]) AS ranking_models
  FROM parsed WHERE ok
)"""

#: The same over every example, with its dense id as eval_id.
EVAL_ALL_CTE = EXAMPLES_CTE + f""",
heldout AS (
  SELECT example_id AS eval_id, instruction, input, {prompt('instruction', 'input')} AS prompt, output AS reference_output FROM examples
)""" + EVAL_CTE.removeprefix(HELDOUT_CTE)


# ---- tokens ------------------------------------------------------------------------------------

PIECE = r" ?[^\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+"


def pieces(x: str) -> str:
    return f"regexp_extract_all({x}, {q(PIECE)})"


def _piece_ids(x: str) -> str:
    return f"list_transform({pieces(x)}, lambda t: CAST((('0x' || substr(md5(t), 1, 8))::BIGINT) % 50256 AS INTEGER))"


def token_ids(x: str) -> str:
    eos = q(C.EOS_TEXT)
    return (
        f"(CASE WHEN ends_with({x}, {eos}) THEN list_concat({_piece_ids(f'left({x}, length({x}) - {len(C.EOS_TEXT)})')}, [50256])"
        f" ELSE {_piece_ids(x)} END)"
    )


def common_prefix_len(p: str, ids: str) -> str:
    pos = f"list_position(list_transform(range(1, len({p}) + 1), lambda i: coalesce({p}[i] = {ids}[i], false)), false)"
    return f"(CASE WHEN coalesce({pos}, 0) = 0 THEN len({p}) ELSE {pos} - 1 END)"
