"""The registered queries as SQL over the given tables, for an independent check.

Written from the definitions of the views and operators, not from their code:
percentages from plain counts, verdicts from per-chunk rows, manifests by text
aggregation.
"""

# ---- shared subqueries ------------------------------------------------------

DEVICE = """
device AS (
  SELECT o_orderkey AS number, o_custkey AS home,
         'DEV-' || lpad(lower(hex(o_orderkey)), greatest(8, length(hex(o_orderkey)))::int, '0') AS device_id,
         round(11.8::double + (o_orderkey % 241) * 0.01::double, 2) AS battery_voltage,
         (10 + o_custkey % 91)::int AS signal_strength,
         CASE WHEN o_orderstatus = 'P' THEN 'Partial' ELSE 'Success' END AS update_status
  FROM orders)"""

FLEET = DEVICE + """,
fleet AS (
  SELECT device_id, r_name AS region, battery_voltage, signal_strength, update_status, number, home
  FROM device
  LEFT JOIN customer ON c_custkey = home
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey)"""

RAW = FLEET + """,
raw AS (
  SELECT device_id, region,
         CASE number % 200 WHEN 1 THEN NULL WHEN 3 THEN 'UNKNOWN' ELSE battery_voltage::varchar END AS battery_voltage,
         CASE number % 200 WHEN 2 THEN -999 ELSE signal_strength END::int AS signal_strength,
         update_status
  FROM fleet),
flagged AS (
  SELECT *, battery_voltage IS NULL OR signal_strength IS NULL AS missing,
         battery_voltage IS NOT NULL AND NOT coalesce(isfinite(try_cast(battery_voltage AS double)), false) AS corrupt,
         signal_strength < 10 OR signal_strength > 100 AS out_of_range
  FROM raw),
classified AS (
  SELECT *, concat_ws(',', CASE WHEN missing THEN 'MISSING' END, CASE WHEN corrupt THEN 'CORRUPT_TYPE' END,
                      CASE WHEN out_of_range THEN 'OUT_OF_RANGE' END) AS defects
  FROM flagged)"""

ACTIONS = RAW + """,
actions AS (
  SELECT device_id, region, battery_voltage, signal_strength, update_status,
         CASE WHEN defects <> '' OR update_status = 'SECURITY_HOLD' THEN 'MANUAL_TRIAGE'
              WHEN update_status = 'Partial' THEN 'RECOVER' ELSE 'NONE' END AS recovery_action
  FROM classified)"""

FEED = """
feed AS (
  SELECT 'DEV-' || lpad(lower(hex(l_orderkey)), greatest(8, length(hex(l_orderkey)))::int, '0')
         || CASE WHEN l_returnflag = 'R' THEN '-X' ELSE '' END AS device_id,
         CASE WHEN l_linestatus = 'F' THEN 'Success' ELSE 'Partial' END AS status,
         l_shipdate, l_linenumber, l_linestatus
  FROM lineitem)"""

CHUNK = """
chunk AS (
  SELECT doc_id AS firmware_id, i::int AS chunk_index, substring(text, i * 500 + 1, 500) AS payload
  FROM (SELECT doc_id, text, unnest(range((length(text) + 499) // 500)) AS i FROM documents)),
hashed AS (
  SELECT firmware_id, chunk_index, sha256(payload) AS hash, strlen(payload)::int AS size FROM chunk),
image AS (
  SELECT doc_id AS firmware_id, 'v1.' || n_chars AS firmware_version, source || '-' || lang AS device_model
  FROM documents),
manifest AS (
  SELECT firmware_id, firmware_version, device_model, coalesce(n, 0)::int AS total_chunks,
         coalesce(s, 0)::bigint AS total_size, 'SHA-256' AS algorithm
  FROM image LEFT JOIN
       (SELECT firmware_id, count(*) AS n, sum(size) AS s FROM hashed GROUP BY 1) USING (firmware_id))"""

# Faults by firmware number modulo 20: of the published manifest, then of the delivery.
_VERIFICATION = CHUNK.replace("%", "%%") + """,
entry AS (
  SELECT firmware_id, chunk_index::varchar AS chunk_key,
         CASE WHEN chunk_index = 0 AND firmware_id %% 20 = 14 THEN NULL
              WHEN chunk_index = 0 AND firmware_id %% 20 = 18 THEN upper(hash) ELSE hash END AS expected_hash
  FROM hashed
  WHERE firmware_id %% 20 <> 12 AND NOT (chunk_index = 0 AND firmware_id %% 20 = 17)
  UNION ALL
  SELECT firmware_id, CASE firmware_id %% 20 WHEN 9 THEN '-1' WHEN 15 THEN 'x1' ELSE '00' END, sha256('')
  FROM manifest WHERE firmware_id %% 20 IN (9, 15, 16)),
head AS (
  SELECT firmware_id, firmware_version,
         CASE WHEN firmware_id %% 20 <> 13 THEN total_chunks END AS total_chunks,
         firmware_id %% 20 <> 12 AS has_chunks, firmware_id %% 20 <> 11 AS signature_valid
  FROM manifest),
%s
keys AS (
  SELECT firmware_id, count(*) AS n, min(CASE WHEN try_cast(chunk_key AS bigint) IS NULL THEN chunk_key END) AS bad_key,
         count(DISTINCT try_cast(chunk_key AS bigint)) AS numbers,
         min(try_cast(chunk_key AS bigint)) AS lowest, max(try_cast(chunk_key AS bigint)) AS highest,
         list_sort(list(try_cast(chunk_key AS bigint))) AS found
  FROM entry GROUP BY 1),
tally AS (
  SELECT firmware_id, count(*) AS delivered FROM received GROUP BY 1),
-- Delivered rows in their order, each against the entry of its place there.
in_place AS (
  SELECT r.firmware_id, bool_and(coalesce(r.chunk_index = r.place AND e.expected_hash = r.actual_hash, false)) AS intact
  FROM (SELECT *, row_number() OVER (PARTITION BY firmware_id ORDER BY chunk_index, actual_hash) - 1 AS place
        FROM received) r
  LEFT JOIN entry e ON e.firmware_id = r.firmware_id AND e.chunk_key = r.place::varchar
  GROUP BY 1),
faults AS (
  SELECT firmware_id, count(*) FILTER (WHERE result = 'ENTRY_WITHOUT_HASH') AS without_hash,
         count(*) FILTER (WHERE result NOT IN ('OK', 'ENTRY_WITHOUT_HASH')) AS bad_chunks
  FROM checked GROUP BY 1),
stage AS (
  SELECT h.*, coalesce(delivered, 0) AS delivered, coalesce(bad_chunks, 0) AS bad_chunks,
         coalesce(without_hash, 0) AS without_hash, coalesce(intact, true) AS intact, bad_key, found,
         bad_key IS NULL AND n = total_chunks AND numbers = n AND lowest = 0 AND highest = n - 1 AS in_sequence
  FROM head h LEFT JOIN tally USING (firmware_id) LEFT JOIN faults USING (firmware_id)
       LEFT JOIN in_place USING (firmware_id) LEFT JOIN keys USING (firmware_id)),
verdict AS (
  SELECT *, CASE
           WHEN NOT signature_valid THEN 'SIGNATURE_FAILED'
           WHEN NOT has_chunks OR total_chunks IS NULL THEN 'STRUCTURE_ERROR'
           WHEN delivered <> total_chunks THEN 'COUNT_MISMATCH'
           WHEN without_hash > 0 THEN 'MALFORMED_MANIFEST'
           WHEN NOT intact THEN 'CHUNK_ERROR'
           WHEN bad_key IS NOT NULL THEN 'MALFORMED_MANIFEST'
           WHEN in_sequence THEN 'OK'
           ELSE 'SEQUENCE_ERROR' END AS verdict
  FROM stage),
counted AS (
  SELECT *, CASE verdict WHEN 'OK' THEN 0 WHEN 'CHUNK_ERROR' THEN bad_chunks ELSE 1 END AS error_count
  FROM verdict)"""

# What was delivered, with faults by firmware number modulo 20, or as it landed: in
# order, without faults.
_DELIVERED = """
received AS (
  SELECT firmware_id,
         CASE WHEN firmware_id % 20 = 2 AND chunk_index = 1 THEN 0 WHEN firmware_id % 20 = 6 AND chunk_index = 0 THEN -1
              WHEN firmware_id % 20 = 8 AND chunk_index = 0 THEN 2147483647 ELSE chunk_index END AS chunk_index,
         CASE WHEN firmware_id % 20 = 4 AND chunk_index = 0 THEN NULL
              WHEN firmware_id % 20 IN (5, 11) AND chunk_index % 2 = 0 THEN sha256(payload || '!')
              ELSE sha256(payload) END AS actual_hash
  FROM chunk WHERE NOT (chunk_index = 0 AND firmware_id % 20 = 7)),"""
_LANDED = """
received AS (SELECT firmware_id, chunk_index, hash AS actual_hash FROM hashed),"""

# The state of each delivered number, however often it came.
_CHECKED = """
checked AS (
  SELECT r.firmware_id, r.chunk_index, times, CASE WHEN times = 1 THEN r.actual_hash END AS actual_hash, e.expected_hash,
         CASE WHEN e.chunk_key IS NULL THEN 'MISSING_IN_MANIFEST'
              WHEN e.expected_hash IS NULL THEN 'ENTRY_WITHOUT_HASH'
              WHEN times > 1 THEN 'REPEATED'
              WHEN r.actual_hash IS NULL THEN 'NOT_HASHABLE'
              WHEN e.expected_hash <> r.actual_hash THEN 'HASH_MISMATCH' ELSE 'OK' END AS result
  FROM (SELECT firmware_id, chunk_index, count(*) AS times, min(actual_hash) AS actual_hash FROM received GROUP BY 1, 2) r
  LEFT JOIN entry e ON e.firmware_id = r.firmware_id AND e.chunk_key = r.chunk_index::varchar),"""

FAULTY = _VERIFICATION % (_DELIVERED + _CHECKED)
LANDED = _VERIFICATION % (_LANDED + _CHECKED)

ERRORS = FAULTY + """,
chunk_error AS (
  SELECT firmware_id, chunk_index::bigint AS position,
         CASE result WHEN 'MISSING_IN_MANIFEST' THEN 'Chunk ' || chunk_index || ': Missing in manifest'
              WHEN 'REPEATED' THEN 'Chunk ' || chunk_index || ': Delivered ' || times || ' times'
              WHEN 'NOT_HASHABLE' THEN 'Chunk ' || chunk_index
                   || ' verification error: object supporting the buffer API required'
              ELSE 'Chunk ' || chunk_index || ': Hash mismatch. Expected ' || left(expected_hash, 16)
                   || '..., got ' || left(actual_hash, 16) || '...' END AS message
  FROM checked
  WHERE result NOT IN ('OK', 'ENTRY_WITHOUT_HASH')
    AND firmware_id IN (SELECT firmware_id FROM verdict WHERE verdict = 'CHUNK_ERROR')),
firmware_error AS (
  SELECT firmware_id, 'CHUNK_ERROR' AS verdict, position, message FROM chunk_error
  UNION ALL
  SELECT firmware_id, verdict, 0,
         CASE verdict
           WHEN 'SIGNATURE_FAILED' THEN 'SIGNATURE VERIFICATION FAILED: Signature verification failed: '
           WHEN 'STRUCTURE_ERROR' THEN CASE WHEN has_chunks THEN 'Manifest missing ''total_chunks'' field'
                                            ELSE 'Manifest missing ''chunks'' field' END
           WHEN 'COUNT_MISMATCH' THEN 'Chunk count mismatch: expected ' || total_chunks || ', got ' || delivered
           WHEN 'SEQUENCE_ERROR' THEN 'Chunk sequence error: expected ['
             || array_to_string(range(delivered), ', ') || '], got [' || array_to_string(found, ', ') || ']'
           ELSE CASE WHEN without_hash > 0 THEN '''hash'''
                     ELSE 'invalid literal for int() with base 10: ''' || bad_key || '''' END
         END
  FROM verdict WHERE verdict NOT IN ('OK', 'CHUNK_ERROR'))"""

DETAIL = """
detail AS (
  SELECT firmware_id, floor(position / 1000.0)::bigint AS part, string_agg(message, ' | ' ORDER BY position) AS details,
         count(*) AS error_count
  FROM firmware_error WHERE verdict <> 'MALFORMED_MANIFEST' GROUP BY 1, 2)"""

_EVENT = """
event AS (
  SELECT device_id, 'FIRMWARE_TAMPER_DETECTED' AS event_type, target.firmware_id,
         TIMESTAMP '2024-01-01 00:00:00' AS "timestamp"
  FROM target JOIN verdict USING (firmware_id) WHERE verdict NOT IN ('OK', 'MALFORMED_MANIFEST'))"""

TARGET = """
target AS (SELECT device_id, home AS firmware_id FROM device)"""


def _sql(shared: str, *more: str) -> str:
    *ctes, body = more
    return "WITH " + ",".join([shared, *ctes]) + "\n" + body.strip()


# ---- queries ----------------------------------------------------------------

_PICK = "md5(device_id || '#7')"
_SAMPLE = f"SELECT device_id FROM device ORDER BY {_PICK}, device_id LIMIT 50"
_SHARD = "('0x' || substr(md5(device_id), 1, 8))::bigint % 4"
_FLEET_COLUMNS = "device_id, region, battery_voltage, signal_strength"
_SHARD_REPORT = f"""
report AS (
  SELECT s.shard_id, coalesce(f.found, 0) AS found, coalesce(f.found, 0) AS updated,
         CASE WHEN f.found > 0 THEN 'RECOVERED' ELSE 'EMPTY' END AS outcome
  FROM (SELECT unnest(range(4)) AS shard_id) s
  LEFT JOIN (SELECT {_SHARD} AS shard_id, count(*) AS found
             FROM device WHERE update_status = 'Partial' GROUP BY 1) f USING (shard_id))"""

# Three change sets in turn, by line number: the last one that names a device counts.
_THREE_SETS = f"""
last_word AS (
  SELECT device_id, status FROM feed
  QUALIFY row_number() OVER (PARTITION BY device_id
    ORDER BY l_linenumber % 3 DESC, l_shipdate DESC, l_linenumber DESC, l_linestatus DESC) = 1),
merged AS (
  SELECT {_FLEET_COLUMNS}, coalesce(status, update_status) AS update_status
  FROM fleet LEFT JOIN last_word USING (device_id))"""

ORACLE: dict[str, str] = {
    "fleet_projection": _sql(FLEET, f"SELECT {_FLEET_COLUMNS}, update_status FROM fleet"),
    "failure_rank": _sql(FLEET, """
        failing AS (
          SELECT region, count(*) AS devices FROM fleet WHERE update_status = 'Partial' GROUP BY region)""", """
        SELECT f.region, 'Partial' AS update_status, f.devices AS device_count,
               round((f.devices::double / (SELECT count(*) FROM fleet a WHERE a.region IS NOT DISTINCT FROM f.region)) * 100, 2)
                 AS failure_rate_percentage,
               1 + (SELECT count(*) FROM failing worse WHERE worse.devices > f.devices) AS failure_rank
        FROM failing f"""),
    "status_counts": _sql(FLEET, 'SELECT update_status, count(*) AS "count" FROM fleet GROUP BY 1'),
    "status_distribution": _sql(
        FLEET, 'SELECT update_status, count(*) AS "count" FROM fleet GROUP BY 1 ORDER BY 2 DESC, 1'),
    "status_summary": _sql(FLEET, """
        everyone AS (SELECT count(*) AS devices FROM fleet)""", """
        SELECT s.update_status, s.n AS device_count, round(s.n * 100.0::double / e.devices, 2) AS percentage
        FROM (SELECT update_status, count(*) AS n FROM fleet GROUP BY update_status) s, everyone e"""),
    "region_status_counts": _sql(
        FLEET, "SELECT region, update_status, count(*) AS device_count FROM fleet GROUP BY 1, 2"),
    "regional_status_pct": _sql(FLEET, """
        SELECT region, update_status,
               round(count(*)::double * 100 / (sum(count(*)) OVER (PARTITION BY region))::double, 2) AS percentage
        FROM fleet GROUP BY 1, 2"""),
    "regional_status_matrix": _sql(FLEET, """
        share AS (
          SELECT region, update_status,
                 round(count(*)::double * 100 / (sum(count(*)) OVER (PARTITION BY region))::double, 2) AS p
          FROM fleet GROUP BY 1, 2)""", """
        SELECT region, max(p) FILTER (WHERE update_status = 'Partial') AS "Partial",
               max(p) FILTER (WHERE update_status = 'Recovered') AS "Recovered",
               max(p) FILTER (WHERE update_status = 'SECURITY_HOLD') AS "SECURITY_HOLD",
               max(p) FILTER (WHERE update_status = 'Success') AS "Success"
        FROM share GROUP BY 1"""),
    "regional_breakdown": _sql(FLEET, """
        SELECT region, count(*) AS total_devices,
               count(*) FILTER (WHERE update_status = 'Partial') AS partial_count,
               count(*) FILTER (WHERE update_status = 'Recovered') AS recovered_count,
               count(*) FILTER (WHERE update_status = 'Success') AS success_count
        FROM fleet GROUP BY 1 ORDER BY 2 DESC, 1"""),
    "regional_failure_rate": _sql(FLEET, """
        SELECT region, count(*) AS total_devices,
               count(*) FILTER (WHERE update_status = 'Partial') AS failed_count,
               round(count(*) FILTER (WHERE update_status = 'Partial')::double * 100 / count(*)::double, 2)
                 AS failure_rate_percentage
        FROM fleet GROUP BY 1 ORDER BY 4 DESC, 1"""),
    "recovery_apply": _sql(FLEET, f"""
        SELECT {_FLEET_COLUMNS},
               CASE WHEN update_status = 'Partial' THEN 'Recovered' ELSE update_status END AS update_status
        FROM fleet"""),
    "recovery_page": _sql(DEVICE, """
        SELECT device_id FROM device WHERE update_status = 'Partial'
        ORDER BY device_id LIMIT 2500 OFFSET 2500"""),
    "recovery_first_page": _sql(DEVICE, """
        SELECT device_id FROM device WHERE update_status = 'Partial' ORDER BY device_id LIMIT 50"""),
    "recovery_shard_report": _sql(DEVICE, _SHARD_REPORT, "SELECT * FROM report"),
    "recovery_tally": _sql(DEVICE, _SHARD_REPORT, """
        SELECT count(*) FILTER (WHERE outcome = 'RECOVERED') AS shards_recovered,
               count(*) FILTER (WHERE outcome = 'EMPTY') AS shards_empty,
               sum(updated)::bigint AS devices_recovered
        FROM report"""),
    "status_update_by_key": _sql(FLEET, FEED, """
        latest AS (
          SELECT device_id, status FROM feed
          QUALIFY row_number() OVER (
            PARTITION BY device_id ORDER BY l_shipdate DESC, l_linenumber DESC, l_linestatus DESC) = 1)""", f"""
        SELECT {_FLEET_COLUMNS}, coalesce(status, update_status) AS update_status
        FROM fleet LEFT JOIN latest USING (device_id)"""),
    "status_update_any": _sql(FLEET, FEED, """
        latest AS (
          SELECT device_id, CASE WHEN l_linenumber % 3 = 1 THEN 'Rolled back from ' || status ELSE status END AS status FROM feed
          QUALIFY row_number() OVER (
            PARTITION BY device_id ORDER BY l_shipdate DESC, l_linenumber DESC, l_linestatus DESC) = 1)""", f"""
        SELECT {_FLEET_COLUMNS}, coalesce(status, update_status) AS update_status
        FROM fleet LEFT JOIN latest USING (device_id)"""),
    "recovery_pages": _sql(DEVICE, """
        listed AS (
          SELECT device_id, (row_number() OVER (ORDER BY device_id) - 1) // 2500 AS page
          FROM device WHERE update_status = 'Partial')""", "SELECT page, device_id FROM listed WHERE page < 4"),
    "fleet_merged": _sql(FLEET, FEED, _THREE_SETS, f"SELECT {_FLEET_COLUMNS}, update_status FROM merged"),
    "region_status_counts_kept": _sql(FLEET, FEED, _THREE_SETS, """
        SELECT region, update_status, count(*) AS device_count FROM merged GROUP BY 1, 2"""),
    "security_hold": _sql(FLEET, FEED, f"""
        SELECT {_FLEET_COLUMNS},
               CASE WHEN device_id IN (SELECT device_id FROM feed WHERE status = 'Partial')
                    THEN 'SECURITY_HOLD' ELSE update_status END AS update_status
        FROM fleet"""),
    "fleet_replaced": _sql(FLEET, f"""
        SELECT {_FLEET_COLUMNS}, replace(update_status, 'Partial', 'Recovered') AS update_status FROM fleet"""),
    "batch_ledger": _sql(DEVICE, """
        numbered AS (SELECT (row_number() OVER (ORDER BY device_id) - 1) // 500 AS batch_id FROM device)""", """
        SELECT batch_id, count(*) AS rows_in_batch,
               (sum(count(*)) OVER (ORDER BY batch_id))::bigint AS running_total
        FROM numbered GROUP BY 1"""),
    "batch_assignment": _sql(DEVICE, """
        SELECT device_id, update_status, (row_number() OVER (ORDER BY device_id) - 1) // 500 AS batch_id
        FROM device"""),
    "load_resumed": _sql(DEVICE, """
        SELECT device_id, update_status, (row_number() OVER (ORDER BY device_id) - 1) // 500 AS batch_id
        FROM device"""),
    "key_violations": _sql(DEVICE, """
        SELECT device_id, count(*) AS row_count FROM device
        GROUP BY 1 HAVING count(*) > 1 OR device_id IS NULL"""),
    "key_violations_feed": _sql(FEED, """
        SELECT device_id, count(*) AS row_count FROM feed
        GROUP BY 1 HAVING count(*) > 1 OR device_id IS NULL"""),
    "sample_exact_n": _sql(FLEET, f"""
        SELECT {_FLEET_COLUMNS}, update_status FROM fleet WHERE device_id IN ({_SAMPLE})"""),
    "sample_update": _sql(FLEET, f"""
        SELECT device_id, region, battery_voltage, update_status,
               CASE WHEN device_id IN ({_SAMPLE}) THEN -999 ELSE signal_strength END::int AS signal_strength
        FROM fleet"""),
    "corruption_classify": _sql(
        RAW, "SELECT device_id, battery_voltage, signal_strength, defects FROM classified"),
    "corruption_counts": _sql(RAW, """
        SELECT 'MISSING' AS defect, count(*) AS row_count FROM flagged WHERE missing HAVING count(*) > 0
        UNION ALL
        SELECT 'CORRUPT_TYPE', count(*) FROM flagged WHERE corrupt HAVING count(*) > 0
        UNION ALL
        SELECT 'OUT_OF_RANGE', count(*) FROM flagged WHERE out_of_range HAVING count(*) > 0"""),
    "quarantine_clean": _sql(RAW, """
        SELECT device_id, region, battery_voltage::double AS battery_voltage, signal_strength, update_status
        FROM classified WHERE defects = ''"""),
    "quarantine_bad": _sql(RAW, f"""
        SELECT {_FLEET_COLUMNS}, update_status, defects FROM classified WHERE defects <> ''"""),
    "quarantine_lines": _sql(RAW, """
        read_line AS (
          SELECT c.device_id, c.defects, number % 200 AS fault,
                 c.device_id || ',,' || coalesce(c.battery_voltage, '') AS head,
                 CASE number % 200 WHEN 11 THEN 'weak' ELSE c.signal_strength::varchar END || ',' || c.update_status AS tail
          FROM classified c JOIN device USING (device_id))""", """
        SELECT device_id, CASE WHEN fault IN (7, 9, 11) THEN 'UNREADABLE_LINE' ELSE defects END AS defects,
               CASE fault WHEN 7 THEN head WHEN 9 THEN head || ',' || tail || ',more' WHEN 11 THEN head || ',' || tail END
                 AS unreadable_line
        FROM read_line WHERE defects <> '' OR fault IN (7, 9, 11)"""),
    "recovery_actions": _sql(ACTIONS, "SELECT * FROM actions"),
    "recovery_actions_csv": _sql(ACTIONS, "SELECT * FROM actions"),
    "triage_count": _sql(ACTIONS, """
        SELECT count(*) FILTER (WHERE recovery_action = 'MANUAL_TRIAGE') AS triage_count FROM actions"""),
    "recovery_action_distribution": _sql(ACTIONS, """
        SELECT recovery_action, count(*) AS "count" FROM actions GROUP BY 1"""),
    "integrity_check": _sql(DEVICE, """
        SELECT count(*) AS row_count, count(*) > 0 AS not_empty, count(*) >= 10000 AS meets_minimum,
               count(*) = (SELECT sum(n) FROM (SELECT count(*) AS n FROM device GROUP BY number % 97)) AS matches_expected
        FROM device"""),
    "firmware_chunks": _sql(CHUNK, "SELECT * FROM hashed"),
    "firmware_manifest": _sql(CHUNK, "SELECT * FROM manifest"),
    "chunk_renumber": _sql(CHUNK, """
        landed AS (
          SELECT firmware_id, chunk_index * 3 + chunk_index % 2 AS sequence, hash FROM hashed
          UNION ALL
          SELECT firmware_id, chunk_index * 3, hash FROM hashed WHERE chunk_index % 2 = 0)""", """
        SELECT firmware_id, (row_number() OVER (PARTITION BY firmware_id ORDER BY sequence) - 1)::int AS chunk_index,
               hash AS actual_hash
        FROM (SELECT DISTINCT * FROM landed)"""),
    "manifest_json": _sql(CHUNK, """
        part AS (
          SELECT firmware_id, string_agg(
                   '"' || chunk_index || '":{"hash":"' || hash || '","index":' || chunk_index
                   || ',"size":' || size || '}', ',' ORDER BY chunk_index::varchar) AS chunks
          FROM hashed GROUP BY 1)""", """
        document AS (
          SELECT firmware_id, '{"algorithm":"' || algorithm || '","chunks":{' || coalesce(chunks, '')
                 || '},"device_model":"' || device_model || '","firmware_version":"' || firmware_version
                 || '","total_chunks":' || total_chunks || ',"total_size":' || total_size || '}' AS manifest_json
          FROM manifest LEFT JOIN part USING (firmware_id))""", """
        SELECT firmware_id, manifest_json, sha256(manifest_json) AS manifest_digest FROM document"""),
    "manifest_canonical": _sql(CHUNK, """
        part AS (
          SELECT firmware_id, string_agg(
                   '"' || chunk_index || '":{"hash":"' || hash || '","index":' || chunk_index
                   || ',"size":' || size || '}', ',' ORDER BY chunk_index::varchar) AS chunks
          FROM hashed GROUP BY 1)""", r"""
        document AS (
          SELECT firmware_id, '{"algorithm":"' || algorithm || '","chunks":{' || coalesce(chunks, '')
                 || '},"device_model":"' || device_model || '","firmware_version":"' || firmware_version
                 || '","release":{"build":{"number":' || total_size || ',"ratio":' || (total_size / 8.0::double)
                 || ',"signed":true},"channels":[null,"' || firmware_version || '"],"notes":"' || device_model
                 || ' \u2013 \u00fcn\u00ef \"code\" \ud83d\ude00\n' || firmware_version
                 || '"},"total_chunks":' || total_chunks || ',"total_size":' || total_size || '}' AS manifest_json
          FROM manifest LEFT JOIN part USING (firmware_id))""", """
        SELECT firmware_id, manifest_json, sha256(manifest_json) AS manifest_digest FROM document"""),
    "manifest_structure_check": _sql(FAULTY, """
        SELECT firmware_id, CASE WHEN NOT has_chunks THEN 'Manifest missing ''chunks'' field'
                                 WHEN total_chunks IS NULL THEN 'Manifest missing ''total_chunks'' field'
                            END AS structure_error
        FROM head"""),
    "chunk_count_check": _sql(FAULTY, """
        SELECT firmware_id, total_chunks, delivered,
               CASE WHEN total_chunks <> delivered
                    THEN 'Chunk count mismatch: expected ' || total_chunks || ', got ' || delivered END AS count_error
        FROM stage WHERE total_chunks IS NOT NULL"""),
    "chunk_hash_check": _sql(FAULTY, """
        SELECT firmware_id, chunk_index::varchar AS chunk_key, actual_hash, expected_hash, result
        FROM checked
        UNION ALL
        SELECT firmware_id, chunk_key, NULL, expected_hash, 'NOT_DELIVERED' FROM entry
        WHERE (firmware_id, chunk_key) NOT IN (SELECT (firmware_id, chunk_index::varchar) FROM received)"""),
    "chunk_sequence_check": _sql(FAULTY, """
        SELECT firmware_id, bad_key, coalesce(in_sequence, false) AS in_sequence,
               CASE WHEN NOT coalesce(in_sequence, false) THEN coalesce(array_to_string(found, ','), '') END AS found_keys
        FROM stage WHERE has_chunks"""),
    "chunk_errors": _sql(ERRORS, "SELECT * FROM chunk_error"),
    "firmware_errors": _sql(ERRORS, "SELECT * FROM firmware_error"),
    "firmware_errors_top3": _sql(ERRORS, """
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY firmware_id ORDER BY position) AS n FROM firmware_error)""", """
        SELECT firmware_id, string_agg(message, ' | ' ORDER BY n) AS errors FROM ranked WHERE n <= 3 GROUP BY 1"""),
    "firmware_verdict": _sql(FAULTY, "SELECT firmware_id, verdict, error_count FROM counted"),
    "firmware_verdict_landed": _sql(LANDED, "SELECT firmware_id, verdict, error_count FROM counted"),
    "firmware_verdict_signed": _sql(FAULTY, "SELECT firmware_id, verdict, error_count FROM counted"),
    "firmware_verdict_contested": _sql(FAULTY, """
        SELECT firmware_id, CASE firmware_id % 20 WHEN 10 THEN 'CONFLICTING_MANIFESTS' ELSE verdict END AS verdict,
               CASE firmware_id % 20 WHEN 10 THEN 1 ELSE error_count END AS error_count
        FROM counted"""),
    "firmware_verdict_documents": _sql(FAULTY, "SELECT firmware_id, verdict, error_count FROM counted"),
    "verdict_counts": _sql(FAULTY, "SELECT verdict, count(*) AS firmware_count FROM verdict GROUP BY 1"),
    "signature_audit": """
        SELECT doc_id AS firmware_id, doc_id % 20 NOT IN (5, 7, 9, 11) AS signature_valid,
               CASE WHEN doc_id % 20 IN (5, 7, 9, 11) THEN 'Signature verification failed: ' END AS signature_error
        FROM documents""",
    "update_outcomes": _sql(FAULTY, DEVICE, TARGET, """
        SELECT device_id, t.firmware_id, firmware_version,
               CASE WHEN verdict = 'OK' THEN 'installed'
                    WHEN verdict IS NULL OR verdict = 'MALFORMED_MANIFEST' THEN 'error'
                    ELSE 'SECURITY_VIOLATION' END AS status,
               coalesce(verdict = 'OK', false) AS verification_passed, coalesce(error_count, 1) AS error_count
        FROM target t LEFT JOIN counted c ON c.firmware_id = t.firmware_id"""),
    "update_errors": _sql(ERRORS, DEVICE, TARGET, """
        hit AS (SELECT firmware_id, count(*) AS device_count FROM target GROUP BY 1)""", """
        SELECT firmware_id, position, message, device_count FROM hit JOIN firmware_error USING (firmware_id)
        UNION ALL
        SELECT firmware_id, 0, 'Firmware image not found', device_count FROM hit
        WHERE firmware_id NOT IN (SELECT firmware_id FROM manifest)"""),
    "event_details": _sql(ERRORS, DETAIL, "SELECT * FROM detail"),
    "security_events": _sql(FAULTY, DEVICE, TARGET, _EVENT, "SELECT * FROM event"),
    "security_events_stored": _sql(FAULTY, DEVICE, TARGET, _EVENT, "SELECT * FROM event"),
    "security_event_texts": _sql(ERRORS, DEVICE, TARGET, _EVENT, DETAIL, """
        SELECT event.*, part, details FROM event LEFT JOIN detail USING (firmware_id)"""),
    "fleet_after_update": _sql(FAULTY, FLEET, f"""
        SELECT {_FLEET_COLUMNS},
               CASE WHEN verdict = 'OK' THEN 'Success'
                    WHEN verdict IS NULL OR verdict = 'MALFORMED_MANIFEST' THEN update_status
                    ELSE 'SECURITY_HOLD' END AS update_status
        FROM fleet LEFT JOIN verdict ON firmware_id = home"""),
    "image_stream_verdict": _sql(FAULTY, """
        SELECT firmware_id, verdict, error_count FROM counted WHERE firmware_id IN (SELECT firmware_id FROM received)"""),
    "chunk_stream_verify": _sql(FAULTY, """
        SELECT DISTINCT r.firmware_id, r.chunk_index, r.actual_hash, e.expected_hash,
               CASE WHEN e.chunk_key IS NULL THEN 'MISSING_IN_MANIFEST'
                    WHEN e.expected_hash IS NULL THEN 'ENTRY_WITHOUT_HASH'
                    WHEN r.actual_hash IS NULL THEN 'NOT_HASHABLE'
                    WHEN e.expected_hash <> r.actual_hash THEN 'HASH_MISMATCH' ELSE 'OK' END AS result
        FROM received r LEFT JOIN entry e ON e.firmware_id = r.firmware_id AND e.chunk_key = r.chunk_index::varchar"""),
}
