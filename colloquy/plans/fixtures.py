"""Deterministic input derivations shared by the Spark queries and their SQL oracles.

The driver tables hold clean conversations and no five-section replies, so defects
and replies are injected by SQL expressions over every row of the given tables
(never a subset). Each expression is plain SQL that Spark and DuckDB both evaluate,
so both sides start from identical inputs while computing results independently.
"""

from __future__ import annotations

NL = "chr(10)"

# Conversation defects by conv_id % 8 (and % 16 for a null text).
TURN_ROLE_SQL = """CASE
  WHEN conv_id % 8 = 1 AND turn = 0 THEN 'critic'
  WHEN conv_id % 8 = 3 AND turn = 1 THEN 'system'
  WHEN conv_id % 8 = 4 AND turn = 0 THEN 'assistant'
  WHEN conv_id % 8 = 5 AND turn = 2 THEN 'assistant'
  WHEN conv_id % 8 = 6 AND turn = 0 THEN 'system'
  WHEN conv_id % 8 = 7 AND turn = 3 THEN NULL
  ELSE role END"""
TURN_TEXT_SQL = """CASE
  WHEN conv_id % 16 = 10 AND turn = 0 THEN NULL
  WHEN conv_id % 8 = 2 AND turn = 1 THEN ' ' || chr(9) || ' '
  ELSE text END"""

SPLIT_SQL = "CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'val' ELSE 'golden' END"

# ---------------------------------------------------------------------------
# Five-section replies synthesised from orders (gold) and their perturbations
# (generated) by o_orderkey % 8; gold replies have a two-line intent when
# o_orderkey % 13 = 0.
# ---------------------------------------------------------------------------
OP_SQL = "CASE o_orderstatus WHEN 'F' THEN 'LOOKUP' WHEN 'O' THEN 'LIST' ELSE 'COUNT' END"
NORM_SQL = f"CASE WHEN o_orderkey % 3 = 0 THEN '(none)' ELSE 'recieve ' || o_orderpriority || {NL} || '↓' || {NL} || 'receive ' || o_orderpriority END"
NORM_BAD_SQL = f"CASE WHEN o_orderkey % 3 = 0 THEN '(none)' ELSE 'recieve ' || o_orderpriority || {NL} || '->' || {NL} || 'receive ' || o_orderpriority END"
LEX_SQL = f"""'- "' || o_orderstatus || '"' || {NL} || '- "order ' || CAST(o_orderkey AS STRING) || '"'"""
LEX_SPACED_SQL = f"""'- "' || o_orderstatus || '"' || {NL} || {NL} || '-   "order ' || CAST(o_orderkey AS STRING) || '"  '"""
LEX_BAD_SQL = f"""'- ' || o_orderstatus || {NL} || '- "order ' || CAST(o_orderkey AS STRING) || '"'"""
URGENT_SQL = "CASE WHEN o_orderpriority LIKE '1-%' THEN 'yes' ELSE 'no' END"
YAML_SQL = f"'semantic:' || {NL} || '  operation: ' || {OP_SQL} || {NL} || '  customer: ' || CAST(o_custkey AS STRING) || {NL} || '  urgent: ' || {URGENT_SQL}"
YAML_BAD_SQL = "'semantic: [left open'"
ENV_SQL = (
    """'{"status": "SUCCESS", "operation": {"type": "' || """ + OP_SQL
    + """ || '"}, "subject": {"entity": "ORDER"}, "qualifiers": [{"attribute": "custkey", "operator": "=", "value": ' || CAST(o_custkey AS STRING) || '}]}'"""
)
ENV_REORDERED_SQL = (
    """'{"qualifiers":[{"value": ' || CAST(o_custkey AS STRING) || ', "operator":"=", "attribute":"custkey"}], "subject":{"entity":"ORDER"}, "operation":{"type":"' || """
    + OP_SQL + """ || '"}, "status":"SUCCESS"} trailing notes'"""
)
ENV_OPEN_SQL = (
    """'{"status": "SUCCESS", "operation": {"type": "' || """ + OP_SQL
    + """ || '"}, "subject": {"entity": "ORDER"}, "qualifiers": []'"""
)
ENV_WRONG_SQL = (
    """'{"status": "SUCCESS", "operation": {"type": "' || """ + OP_SQL
    + """ || '"}, "subject": {"entity": "ORDER"}, "qualifiers": [{"attribute": "custkey", "operator": "=", "value": ' || CAST(o_custkey + 1 AS STRING) || '}]}'"""
)
GOLD_INTENT_SQL = f"CASE WHEN o_orderkey % 13 = 0 THEN {OP_SQL} || {NL} || 'EXTRA' ELSE {OP_SQL} END"


def _reply(norm: str, lex: str, intent: str, yaml: str, env: str) -> str:
    nn = f"{NL} || {NL}"
    return (
        f"'PASS_0' || {NL} || 'Normalization' || {NL} || {norm} || {nn} || "
        f"'PASS_1' || {NL} || 'Lexical Detection' || {NL} || {lex} || {nn} || "
        f"'PASS_2' || {NL} || 'Intent' || {NL} || {intent} || {nn} || "
        f"'PASS_3' || {NL} || {yaml} || {nn} || "
        f"'PASS_4' || {NL} || {env}"
    )


GOLD_SQL = _reply(NORM_SQL, LEX_SQL, GOLD_INTENT_SQL, YAML_SQL, ENV_SQL)
# One text whose parts vary by o_orderkey % 8 (code for eight whole texts is too long for Java's compiler).
GENERATED_SQL = _reply(
    f"CASE WHEN o_orderkey % 8 = 5 THEN {NORM_BAD_SQL} ELSE {NORM_SQL} END",
    f"CASE o_orderkey % 8 WHEN 1 THEN {LEX_SPACED_SQL} WHEN 4 THEN {LEX_BAD_SQL} ELSE {LEX_SQL} END",
    f"CASE WHEN o_orderkey % 8 = 2 THEN 'UNSUPPORTED' ELSE {GOLD_INTENT_SQL} END",
    f"CASE WHEN o_orderkey % 8 = 6 THEN {YAML_BAD_SQL} ELSE {YAML_SQL} END",
    f"CASE o_orderkey % 8 WHEN 1 THEN {ENV_REORDERED_SQL} WHEN 3 THEN {ENV_OPEN_SQL} "
    f"ELSE CASE WHEN o_orderkey % 8 IN (0, 2, 4, 5, 6) THEN {ENV_SQL} ELSE {ENV_WRONG_SQL} END END",
)

# Canonical keys the oracle expects for a correct parse.
ENV_CANON_SQL = (
    """'{"operation":{"type":"' || """ + OP_SQL
    + """ || '"},"qualifiers":[{"attribute":"custkey","operator":"=","value":' || CAST(o_custkey AS STRING) || '}],"status":"SUCCESS","subject":{"entity":"ORDER"}}'"""
)
ENV_WRONG_CANON_SQL = (
    """'{"operation":{"type":"' || """ + OP_SQL
    + """ || '"},"qualifiers":[{"attribute":"custkey","operator":"=","value":' || CAST(o_custkey + 1 AS STRING) || '}],"status":"SUCCESS","subject":{"entity":"ORDER"}}'"""
)
SEM_CANON_SQL = (
    """'{"semantic":{"customer":' || CAST(o_custkey AS STRING) || ',"operation":"' || """ + OP_SQL
    + """ || '","urgent":' || CASE WHEN o_orderpriority LIKE '1-%' THEN '1' ELSE '0' END || '}}'"""
)
NORM_CANON_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'recieve ' || o_orderpriority || '=>receive ' || o_orderpriority END"
LEX_CANON_SQL = "o_orderstatus || '|order ' || CAST(o_orderkey AS STRING)"

# ---------------------------------------------------------------------------
# Events as captured generation streams (request = user x day, seq = event_id).
# ---------------------------------------------------------------------------
REQUEST_SQL = "CAST(user_id AS STRING) || '@' || CAST(CAST(ts AS DATE) AS STRING)"
SSE_LINE_SQL = """CASE
  WHEN event_type = 'purchase' AND value > 45 THEN 'data: [DONE]'
  WHEN event_type = 'view' AND value < 3 THEN ': keep-alive'
  WHEN event_type = 'error' THEN 'data: {"choices": [{"delta": {}}]}'
  ELSE 'data: {"choices": [{"delta": {"content": "' || event_type || ' "}}], "usage": {"completion_tokens": ' || CAST(CAST(event_id % 97 AS BIGINT) AS STRING) || '}}'
END"""
NDJSON_LINE_SQL = """CASE
  WHEN event_type = 'purchase' AND value > 45 THEN '{"message": {"content": "end"}, "done": true, "eval_count": ' || CAST(CAST(event_id % 50 AS BIGINT) AS STRING) || ', "eval_duration": ' || CAST(CAST(event_id % 7 AS BIGINT) * 250000000 AS STRING) || '}'
  WHEN event_type = 'error' THEN '{"message": {"content": ""}, "done": false}'
  ELSE '{"message": {"content": "' || event_type || ' "}, "done": false}'
END"""

# Robustness: group = user, level = 1 + event_id % 4, reply envelope from the event.
LEVEL_SQL = "CAST(1 + event_id % 4 AS INT)"
ROBUST_REPLY_SQL = f"""CASE
  WHEN event_type = 'error' THEN 'PASS_4' || {NL} || '{{"status": "SUCCESS", "operation": {{"type": "LOOKUP"'
  ELSE 'PASS_2' || {NL} || 'Intent' || {NL} || 'LOOKUP' || {NL} || {NL} || 'PASS_4' || {NL} || '{{"status": "SUCCESS", "operation": {{"type": "' || CASE WHEN event_type IN ('view', 'click') THEN 'LOOKUP' ELSE upper(event_type) END || '"}}, "subject": {{"entity": "PARCEL"}}, "qualifiers": []}}'
END"""

# ---------------------------------------------------------------------------
# Run registry rows: one run per order, one checkpoint per line item.
# ---------------------------------------------------------------------------
BASE_DIR_SQL = "'drive/c' || CAST(o_custkey % 50 AS STRING)"
RUN_NAME_SQL = """CASE WHEN o_orderkey % 10 = 9 THEN 'run_manual_' || CAST(o_orderkey AS STRING)
  ELSE 'run_' || CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING) || '_'
       || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')
       || lpad(CAST((o_orderkey * 7) % 60 AS STRING), 2, '0') END"""
HAS_ADAPTER_SQL = "o_orderstatus <> 'P'"
CKPT_NAME_SQL = """CASE WHEN l_partkey % 17 = 0 THEN 'checkpoint-final'
  ELSE 'checkpoint-' || CAST(l_linenumber * 250 + (l_partkey % 7) * 50 AS STRING) END"""
CKPT_LOSS_SQL = "l_tax"

# Prior manifests per customer and child configs per order.
PRIOR_PATH_SQL = "'adapters/' || CAST(c_custkey AS STRING)"
PRIOR_BASE_SQL = "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'prior-' || c_mktsegment END"
PRIOR_R_SQL = "CAST(8 * (1 + c_custkey % 4) AS BIGINT)"
PRIOR_ALPHA_SQL = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(16 * (1 + c_custkey % 4) AS BIGINT) END"
PRIOR_LEN_SQL = "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(1024 + (c_custkey % 3) * 512 AS BIGINT) END"
CHILD_LINK_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'adapters/' || CAST(o_custkey AS STRING) END"

# Trainer logs from events: run = user % 20, step = event_id.
LOG_KEY_SQL = """CASE event_type WHEN 'click' THEN 'loss' WHEN 'view' THEN 'learning_rate' WHEN 'purchase' THEN 'grad_norm'
  WHEN 'signup' THEN 'epoch' ELSE 'eval_loss' END"""
LOG_SOURCE_SQL = "CASE WHEN event_type = 'error' THEN 'eval' ELSE 'train' END"

# Raw JSONL lines from conversations: corruptions by conv_id % 9 (and % 18).
JSONL_LINE_SQL = """CASE
  WHEN conv_id % 9 = 0 THEN '{broken row ' || CAST(conv_id AS STRING)
  WHEN conv_id % 9 = 1 THEN '[1, 2, 3]'
  WHEN conv_id % 18 = 2 THEN '{}'
  WHEN conv_id % 18 = 11 THEN '{"messages": null}'
  WHEN conv_id % 18 = 3 THEN '{"messages": []}'
  WHEN conv_id % 18 = 12 THEN '{"messages": "hi"}'
  WHEN conv_id % 9 = 4 THEN '{"messages": [{"role": 5, "content": "x"}]}'
  WHEN conv_id % 9 = 5 THEN json_line || ' x'
  WHEN conv_id % 9 = 6 THEN '{"messages": ["hello"]}'
  WHEN conv_id % 9 = 7 THEN '   '
  ELSE json_line END"""
