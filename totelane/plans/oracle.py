"""The same queries as plain SQL, to check results in another engine.

Written for reading, not for scale: each statement joins the tables row by row and removes
duplicates at the end, while the DataFrame code reduces every level first. The values of the
rules are written out here again, so that a wrong one in the operators shows.
"""

from __future__ import annotations

from totelane.sources.testdata import AS_OF, view_texts

# Fixed values of the rules, as in the source database.
_NONCON_AREAS = "('WW', 'XX', 'YY', 'ZZ')"
_SPREAD = (
    "['AD','AF','AH','BA','BB','BC','BD','CB','CD','CF','CH','DA','DB','DC','DD',"
    "'EF','EH','FA','FC','GF','GH','HA','HC','IF','IH','JA','JC']"
)
_LEGACY = "['AD','AD','AD','CB','AF','AF','AF','FA','GH','IF']"

_AS_OF = f"TIMESTAMP '{AS_OF.isoformat(sep=' ')}'"


_VIEWS = {f"raw_{name}": text for name, text in view_texts("TIMESTAMP").items()}

_TABLES = ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items()) + """,
trans AS (
    SELECT tran_id, upper(trim(tran_type)) AS tran_type, upper(trim(inventory_id)) AS inventory_key,
        upper(trim(to_location_id)) AS to_location_key, upper(trim(location_id)) AS location_key
    FROM raw_trans),
trans_detail AS (
    SELECT tran_id, upper(trim(order_id)) AS order_key, upper(trim(location_id)) AS location_key
    FROM raw_trans_detail),
tote_detail AS (
    SELECT trim(tote_id) AS tote_id, upper(trim(tote_id)) AS tote_key,
        upper(trim(inventory_id)) AS inventory_key
    FROM raw_tote_detail),
wh_orders AS (
    SELECT upper(trim(order_id)) AS order_key, upper(trim(status)) AS status FROM raw_wh_orders),
multi_home_loc AS (
    SELECT upper(trim(product_id)) AS product_key, upper(trim(home_loc_id)) AS location_key
    FROM raw_multi_home_loc),
zone AS (SELECT upper(trim(zone_id)) AS zone_key, picking FROM raw_zone),
zone_locations AS (
    SELECT upper(trim(location_id)) AS location_key, upper(trim(zone_id)) AS zone_key,
        trim(zone_id) AS zone_id
    FROM raw_zone_locations),
tote_router AS (
    SELECT id, tote_id, upper(trim(tote_id)) AS tote_key, route, chute, noncon, routed_date
    FROM raw_tote_router)"""

_PICKS = f"""
open_picks AS (
    SELECT DISTINCT lines.order_key,
        CASE WHEN left(lines.location_key, 2) IN {_NONCON_AREAS} THEN 'NC'
            WHEN left(lines.location_key, 3) BETWEEN '1UA' AND '1XG'
                THEN lines.location_key
            WHEN left(lines.location_key, 2) BETWEEN '00' AND '99' THEN 'NC'
            ELSE lines.location_key END AS location_key
    FROM trans_detail lines JOIN trans USING (tran_id)
    WHERE trans.tran_type = 'PICK' AND lines.order_key > '')"""

_DESTINATIONS = """
moves AS (SELECT * FROM trans WHERE inventory_key > ''),
levels AS (
    SELECT items.tote_id, items.tote_key, items.inventory_key,
        open_picks.location_key AS pick, refills.to_location_key AS refill,
        tote_moves.location_key AS tote_move, item_moves.location_key AS item_move,
        homes.location_key AS home,
        CASE WHEN wh_orders.status = 'PICKED' THEN 'PACKING'
            WHEN wh_orders.status IS NOT NULL THEN 'NC' END AS by_status
    FROM tote_detail items
    LEFT JOIN open_picks ON open_picks.order_key = items.inventory_key
    LEFT JOIN moves refills
        ON refills.tran_type = 'REPL' AND refills.inventory_key = items.tote_key
    LEFT JOIN moves tote_moves
        ON tote_moves.tran_type = 'PUTAWAY' AND tote_moves.inventory_key = items.tote_key
    LEFT JOIN moves item_moves
        ON item_moves.tran_type = 'PUTAWAY' AND item_moves.inventory_key = items.inventory_key
    LEFT JOIN multi_home_loc homes ON homes.product_key = items.inventory_key
    LEFT JOIN wh_orders ON wh_orders.order_key = items.inventory_key
    WHERE items.tote_key IS NOT NULL),
destinations AS (
    SELECT tote_id, tote_key, inventory_key,
        CASE WHEN pick IS NULL THEN 'PUTAWAY' ELSE 'SINGLE' END AS tote_state,
        CAST(CASE WHEN pick IS NOT NULL THEN 1 WHEN refill IS NOT NULL THEN 2
            WHEN tote_move IS NOT NULL THEN 3 WHEN item_move IS NOT NULL THEN 4
            WHEN home IS NOT NULL THEN 5 WHEN by_status IS NOT NULL THEN 6 ELSE 7 END AS INT)
            AS dest_level,
        coalesce(pick, refill, tote_move, item_move, home, by_status, 'HOSPITAL') AS location_key
    FROM levels)"""

_ZONE_MAP = """
zone_map AS (
    SELECT location_key, max({'k': zone_key, 'z': zone_id}).z AS zone
    FROM zone_locations JOIN zone USING (zone_key) WHERE picking = 1
    GROUP BY location_key)"""


def _rule(location: str) -> str:
    floor = f"left({location}, 3)"
    return f"""CASE WHEN {location} = 'PACKING' THEN 'Packing'
        WHEN {floor} BETWEEN '1UA' AND '1VA' THEN 'FB' WHEN {floor} BETWEEN '1VB' AND '1VF' THEN 'FD'
        WHEN {floor} BETWEEN '1VG' AND '1WB' THEN 'HB' WHEN {floor} BETWEEN '1WC' AND '1WG' THEN 'HD'
        WHEN {floor} BETWEEN '1WH' AND '1XB' THEN 'JB' WHEN {floor} BETWEEN '1XC' AND '1XG' THEN 'JD'
        END"""


def _spread(tote: str, zones: str) -> str:
    draw = f"('0x' || substr(md5({tote}), 1, 6))::BIGINT % len({zones}) + 1"
    return f"list_extract({zones}, {draw})"


def _zones(states: str, spread: str = _SPREAD) -> str:
    return f"""
zoned AS (
    SELECT DISTINCT tote_id, tote_key, location_key,
        CASE WHEN location_key = 'RANDOM' THEN {_spread('tote_key', spread)}
            ELSE coalesce({_rule('location_key')}, zone_map.zone, 'NC') END AS zone
    FROM destinations LEFT JOIN zone_map USING (location_key)
    WHERE tote_state IN ({states})),
tote_zones AS (SELECT tote_key, min(zone) AS zone FROM zoned GROUP BY tote_key, upper(zone))"""


_ROUTES = """
spelled AS (SELECT tote_key, min(tote_id) AS tote_id FROM zoned GROUP BY tote_key),
tote_routes AS (
    SELECT tote_key, string_agg(zone, '-' ORDER BY upper(zone)) AS origroute
    FROM tote_zones WHERE length(tote_key) > 1 GROUP BY tote_key),
flagged AS (
    SELECT tote_key, origroute,
        replace(origroute, 'NC', '-') AS r1,
        CASE WHEN contains(origroute, 'NC') OR contains(replace(origroute, 'NC', '-'), 'Hospital')
            THEN 4 ELSE 0 END AS noncon
    FROM tote_routes),
rewritten AS (
    SELECT tote_key, origroute, CAST(noncon AS INT) AS noncon,
        CASE WHEN contains(r1, 'Hospital') OR contains(r1, 'Packing') THEN '-' ELSE r1 END AS route
    FROM flagged),
preroute AS (
    SELECT r.tote_key, s.tote_id, r.origroute, r.route,
        CAST(CASE WHEN r.route = '-' THEN 4 ELSE 3 END AS INT) AS chute, r.noncon
    FROM rewritten r JOIN spelled s ON r.tote_key = s.tote_key)"""

_STATE = f"""
expired AS (
    SELECT * FROM tote_router WHERE {_AS_OF} > routed_date + INTERVAL '1' HOUR),
purged AS (
    SELECT * FROM tote_router s
    WHERE NOT EXISTS (SELECT 1 FROM expired e WHERE e.tote_key = s.tote_key)),
stored AS (
    SELECT * FROM purged WHERE tote_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tote_key ORDER BY id DESC) = 1)"""

_RECONCILE = """
completed AS (
    SELECT s.tote_key, s.tote_id, '-' AS path,
        CAST(CASE WHEN s.noncon = 4 THEN 4 ELSE 1 END AS INT) AS chute, s.noncon, s.route
    FROM stored s
    WHERE NOT EXISTS (SELECT 1 FROM tote_zones z WHERE z.tote_key = s.tote_key)),
reconciled AS (
    SELECT p.tote_key, p.tote_id,
        CASE WHEN lower(coalesce(s.route, '')) = lower(p.route) THEN 'KEEP'
            WHEN s.id IS NULL THEN 'INSERT'
            WHEN coalesce(s.route, '') = '' THEN 'INSERT_ON_BLANK'
            ELSE 'REPLACE' END AS action,
        p.origroute, p.route, p.chute, p.noncon, s.route AS stored_route
    FROM preroute p LEFT JOIN stored s ON p.tote_key = s.tote_key
    UNION ALL
    SELECT tote_key, tote_id, 'COMPLETE', NULL, path, chute, coalesce(noncon, 0), route
    FROM completed)"""

_NEXT = """
inserts AS (
    SELECT (SELECT max(id) FROM tote_router) + row_number() OVER (ORDER BY tote_key) AS id,
        tote_id, tote_key, route, chute, noncon, CAST(NULL AS TIMESTAMP) AS routed_date
    FROM reconciled WHERE action IN ('INSERT', 'INSERT_ON_BLANK', 'REPLACE')),
next_state AS (
    SELECT id, tote_id, tote_key, route, chute, noncon, routed_date FROM purged s
    WHERE NOT EXISTS (SELECT 1 FROM reconciled r
        WHERE r.tote_key = s.tote_key AND r.action IN ('REPLACE', 'COMPLETE'))
    UNION ALL
    SELECT id, tote_id, tote_key, route, chute, noncon, routed_date FROM inserts)"""

_OUTBOX = """
messages AS (
    SELECT 'COMPLETION' AS kind, CAST(NULL AS BIGINT) AS id, tote_key, trim(tote_id) AS tote_id,
        path, chute
    FROM completed
    UNION ALL
    SELECT 'ROUTE', id, tote_key, tote_id, route, chute
    FROM next_state WHERE routed_date IS NULL AND route IS NOT NULL AND tote_key IS NOT NULL),
outbox AS (
    SELECT row_number() OVER (ORDER BY id NULLS FIRST, tote_key) AS seq, kind, id, tote_key,
        tote_id, path, chute,
        '{"tote":"' || tote_id || '","path":"' || path || '","chute":' || chute || '}' AS payload
    FROM messages),
acks AS (
    SELECT seq, id, tote_id, CASE WHEN seq % 7 = 0 THEN 500 ELSE 201 END AS status
    FROM outbox WHERE seq % 11 <> 0),
answers AS (
    SELECT id, tote_id, status FROM acks
    UNION ALL SELECT id, tote_id, status FROM acks WHERE seq % 13 = 0),
marked AS (
    SELECT n.id, n.tote_id, n.route, n.chute, n.noncon,
        CASE WHEN n.routed_date IS NULL AND a.status = 201 THEN AS_OF ELSE n.routed_date END
            AS routed_date
    FROM next_state n LEFT JOIN acks a ON n.id = a.id AND n.tote_id = a.tote_id)""".replace(
    "AS_OF", _AS_OF
)

_EVENTS = """WITH arrived AS (
    SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS start,
        (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) + CASE WHEN event_id % 31 = 0 THEN 12
            WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) // 7 AS week
    FROM events),
marks AS (
    SELECT week, date_trunc('millisecond', max(max(ts)) OVER (
        ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 2 DAY AS mark
    FROM arrived GROUP BY week)
SELECT start, start + INTERVAL 6 HOUR AS "end", event_type, count(*) AS events,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM arrived JOIN marks USING (week)
WHERE mark IS NULL OR start + INTERVAL 6 HOUR > mark
GROUP BY start, event_type"""

_SIGHTINGS = f"""
sightings AS (
    SELECT tote_key, zone, {_AS_OF} + INTERVAL 1 MINUTE * CAST(
        ('0x' || substr(md5(tote_key || '/' || zone), 1, 6))::BIGINT % 240 AS INT) AS seen
    FROM tote_zones),
sessions AS (
    SELECT tote_key, min(seen) AS opened FROM sightings GROUP BY tote_key
    UNION ALL
    SELECT s.tote_key, min(t.seen) FROM sessions s JOIN sightings t
        ON t.tote_key = s.tote_key AND t.seen > s.opened + INTERVAL 1 HOUR
    GROUP BY s.tote_key, s.opened)"""

_TOLD = """
told AS (
    SELECT seq, CASE WHEN seq % 7 = 0 THEN 500 ELSE 201 END AS status, seq % 40 AS minutes
    FROM outbox WHERE seq % 11 <> 0
    UNION ALL
    SELECT seq, 201, seq % 40 + 5 FROM outbox WHERE seq % 11 <> 0 AND seq % 13 = 0),
heard AS (SELECT seq, bool_or(status = 201) AS accepted FROM told WHERE minutes <= 30 GROUP BY seq),
outcomes AS (SELECT o.*, h.accepted FROM outbox o LEFT JOIN heard h USING (seq))"""


def _part(tote: str) -> str:
    return f"CAST(('0x' || substr(md5(coalesce({tote}, '')), 1, 6))::BIGINT % 256 AS INT)"


_SINGLE, _PUTAWAY, _BOTH = "'SINGLE'", "'PUTAWAY'", "'SINGLE', 'PUTAWAY'"
_OPEN = [_TABLES, _PICKS, _DESTINATIONS, _ZONE_MAP]
_PLAN = [*_OPEN, _zones(_SINGLE), _ROUTES]
_RUN = [*_PLAN, _STATE, _RECONCILE]
_EFFECTS = [*_RUN, _NEXT, _OUTBOX]

_STATE_COLUMNS = "id, tote_id, route, chute, noncon, routed_date"
_REPORT = "SELECT tote_key, tote_id, origroute, route, chute, noncon FROM preroute"


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


ORACLE: dict[str, str] = {
    "pick_locations": _sql([_TABLES, _PICKS], "SELECT order_key, location_key FROM open_picks"),
    "replenishments": _sql(
        [_TABLES],
        "SELECT DISTINCT inventory_key, to_location_key AS location_key FROM trans "
        "WHERE tran_type = 'REPL' AND inventory_key > ''",
    ),
    "putaways": _sql(
        [_TABLES],
        "SELECT DISTINCT inventory_key, location_key FROM trans "
        "WHERE tran_type = 'PUTAWAY' AND inventory_key > ''",
    ),
    "home_locations": _sql(
        [_TABLES], "SELECT DISTINCT product_key, location_key FROM multi_home_loc"
    ),
    "order_destinations": _sql(
        [_TABLES],
        "SELECT DISTINCT order_key, CASE WHEN status IS NULL THEN NULL "
        "WHEN status = 'PICKED' THEN 'PACKING' ELSE 'NC' END AS location_key FROM wh_orders",
    ),
    "tote_destinations": _sql(
        _OPEN[:3],
        "SELECT DISTINCT tote_key, inventory_key, tote_state, dest_level, location_key "
        "FROM destinations",
    ),
    "destination_levels": _sql(
        _OPEN[:3],
        "SELECT dest_level, tote_state, count(*) AS destinations FROM (SELECT DISTINCT tote_key, "
        "inventory_key, tote_state, dest_level, location_key FROM destinations) GROUP BY ALL",
    ),
    "location_zone_map": _sql([_TABLES, _ZONE_MAP], "SELECT location_key, zone FROM zone_map"),
    "zone_by_rule": _sql(
        [_TABLES, _PICKS],
        f"SELECT DISTINCT location_key, {_rule('location_key')} AS zone FROM open_picks",
    ),
    "zone_by_rule_table": _sql(
        [_TABLES, _PICKS],
        """SELECT location_key, arg_min(zone, {'r': rank, 'z': zone}) AS zone
        FROM (SELECT DISTINCT location_key FROM open_picks WHERE location_key IS NOT NULL)
        LEFT JOIN (
            SELECT * FROM (VALUES ('1UA', '1VA~', 'FB', 0), ('1VB', '1VF~', 'FD', 1),
                ('1VG', '1WB~', 'HB', 2), ('1WC', '1WG~', 'HD', 3), ('1WH', '1XB~', 'JB', 4),
                ('1XC', '1XG~', 'JD', 5)) t(low, high, zone, rank)
            UNION ALL
            SELECT least(location_key, reverse(location_key)),
                greatest(location_key, reverse(location_key)), min(zone_id), count(*) + 100
            FROM zone_locations WHERE location_key IS NOT NULL GROUP BY location_key)
        ON location_key BETWEEN low AND high GROUP BY location_key""",
    ),
    "random_zone_spread": _sql(
        _OPEN[:3],
        f"SELECT DISTINCT tote_key, {_spread('tote_key', _SPREAD)} AS zone, "
        f"{_spread('tote_key', _LEGACY)} AS legacy_zone "
        "FROM destinations WHERE location_key = 'RANDOM'",
    ),
    "tote_zones": _sql([*_OPEN, _zones(_SINGLE)], "SELECT tote_key, zone FROM tote_zones"),
    "tote_zones_all_states": _sql(
        [*_OPEN, _zones(_BOTH)], "SELECT tote_key, zone FROM tote_zones"
    ),
    "tote_routes": _sql(_PLAN, "SELECT tote_key, origroute FROM tote_routes"),
    "route_rewrite": _sql(
        _PLAN,
        "SELECT origroute, route, noncon, count(*) AS totes FROM rewritten "
        "GROUP BY origroute, route, noncon",
    ),
    "chute_assignment": _sql(_PLAN, "SELECT chute, count(*) AS totes FROM preroute GROUP BY chute"),
    "preroute_report": _sql(_PLAN, _REPORT),
    "preroute_report_all_states": _sql([*_OPEN, _zones(_BOTH), _ROUTES], _REPORT),
    "preroute_report_putaway": _sql([*_OPEN, _zones(_PUTAWAY), _ROUTES], _REPORT),
    "preroute_report_legacy": _sql(
        [*_OPEN, _zones(_SINGLE, _LEGACY), _ROUTES], _REPORT
    ),
    "taken_in_report": _sql(_PLAN, _REPORT),
    "expired_routes": _sql([_TABLES, _STATE], "SELECT id, tote_key, routed_date FROM expired"),
    "pending_routes": _sql(
        [_TABLES],
        "SELECT id, tote_id, route, chute FROM tote_router WHERE routed_date IS NULL",
    ),
    "state_after_purge": _sql([_TABLES, _STATE], f"SELECT {_STATE_COLUMNS} FROM purged"),
    "stored_route_lookup": _sql(
        [_TABLES, _STATE],
        "SELECT tote_key, id AS stored_id, route AS stored_route, noncon AS stored_noncon "
        "FROM stored",
    ),
    "open_vs_state": _sql(
        [*_OPEN, _zones(_SINGLE), _STATE],
        "SELECT coalesce(z.tote_key, s.tote_key) AS tote_key, "
        "CASE WHEN z.tote_key IS NOT NULL THEN 'SINGLE' END AS tote_state, "
        "CAST(3 AS INT) AS chute, coalesce(z.zone, 'NC') AS zone, s.tote_key AS state_tote, "
        "s.noncon FROM tote_zones z FULL OUTER JOIN stored s ON z.tote_key = s.tote_key",
    ),
    "completed_totes": _sql(_RUN, "SELECT tote_key, path, chute FROM completed"),
    "lost_completions": _sql(
        [*_OPEN, _zones(_SINGLE), _STATE],
        "SELECT DISTINCT e.tote_key FROM expired e WHERE e.tote_key IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM tote_zones z WHERE z.tote_key = e.tote_key)",
    ),
    "rejected_rows": _sql(
        [_TABLES],
        "SELECT 'tote_detail' AS source, inventory_key AS item FROM tote_detail "
        "WHERE tote_key IS NULL UNION ALL "
        "SELECT 'tote_router', CAST(id AS VARCHAR) FROM tote_router WHERE tote_key IS NULL",
    ),
    "route_reconcile": _sql(
        _RUN,
        "SELECT tote_key, tote_id, action, origroute, route, chute, noncon, stored_route "
        "FROM reconciled",
    ),
    "state_inserts": _sql([*_RUN, _NEXT], f"SELECT {_STATE_COLUMNS} FROM inserts"),
    "next_state": _sql([*_RUN, _NEXT], f"SELECT {_STATE_COLUMNS} FROM next_state"),
    "dispatch_outbox": _sql(
        _EFFECTS, "SELECT seq, kind, id, tote_id, path, chute, payload FROM outbox"
    ),
    "accepted_answers": _sql(_EFFECTS, "SELECT id, tote_id FROM answers WHERE status = 201"),
    "failed_dispatches": _sql(
        _EFFECTS,
        "SELECT id, tote_id, path, chute FROM outbox o WHERE id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM acks a WHERE a.id = o.id AND a.tote_id = o.tote_id AND a.status = 201)",
    ),
    "mark_routed": _sql(_EFFECTS, f"SELECT {_STATE_COLUMNS} FROM marked"),
    "streamed_run": _sql(_EFFECTS, f"SELECT {_STATE_COLUMNS} FROM marked"),
    "run_summary": _sql(
        _EFFECTS,
        """SELECT event, count(*) AS n FROM (
            SELECT 'EXPIRED' AS event FROM expired
            UNION ALL SELECT action FROM reconciled
            UNION ALL SELECT 'DISPATCHED' FROM outbox WHERE id IS NOT NULL
            UNION ALL SELECT CASE WHEN status = 201 THEN 'ROUTED' WHEN status = 500 THEN 'FAILED'
                ELSE 'UNANSWERED' END FROM outbox LEFT JOIN acks USING (seq)
                WHERE outbox.id IS NOT NULL
            UNION ALL SELECT CASE WHEN status = 500 THEN 'COMPLETION_FAILED'
                ELSE 'COMPLETION_UNANSWERED' END FROM outbox LEFT JOIN acks USING (seq)
                WHERE outbox.id IS NULL AND coalesce(status, 0) <> 201
            UNION ALL SELECT 'HELD_WITHOUT_ROUTE' FROM next_state
                WHERE routed_date IS NULL AND route IS NULL
            UNION ALL SELECT 'REJECTED' FROM tote_detail WHERE tote_key IS NULL
            UNION ALL SELECT 'REJECTED' FROM tote_router WHERE tote_key IS NULL)
        GROUP BY event""",
    ),
}

ORACLE |= {
    "event_counts": _EVENTS,
    "stateful_routes": _sql(
        [*_OPEN, _zones(_SINGLE), _SIGHTINGS],
        "SELECT s.tote_key, string_agg(t.zone, '-' ORDER BY upper(t.zone)) AS origroute, s.opened, "
        "s.opened + INTERVAL 1 HOUR AS expires FROM sessions s JOIN sightings t "
        "ON t.tote_key = s.tote_key AND t.seen BETWEEN s.opened AND s.opened + INTERVAL 1 HOUR "
        "GROUP BY s.tote_key, s.opened",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "incremental_routes": _sql(_PLAN, _REPORT),
    "incremental_reconcile": ORACLE["route_reconcile"],
    "streamed_answers": _sql(
        [*_EFFECTS, _TOLD],
        """SELECT seq, kind, id, tote_id,
            CASE WHEN id IS NULL AND accepted IS NULL THEN 'COMPLETION_UNANSWERED'
                WHEN id IS NULL AND NOT accepted THEN 'COMPLETION_FAILED'
                WHEN id IS NULL THEN NULL
                WHEN accepted IS NULL THEN 'UNANSWERED' WHEN accepted THEN 'ROUTED' ELSE 'FAILED'
                END AS event
        FROM outcomes""",
    ),
    "answered_state": _sql(
        [*_EFFECTS, _TOLD],
        f"""SELECT n.id, n.tote_id, n.route, n.chute, n.noncon,
            CASE WHEN o.accepted THEN {_AS_OF} ELSE n.routed_date END AS routed_date
        FROM next_state n LEFT JOIN outcomes o ON o.id = n.id""",
    ),
    "sent_messages": _sql(_EFFECTS, "SELECT 'run' AS run, seq, payload FROM outbox"),
    "answered_parts": _sql(
        [_TABLES],
        f"""SELECT part, count(*) AS n,
            count(CASE WHEN answered THEN {_AS_OF} ELSE routed_date END) AS routed,
            bool_or(answered) AS written
        FROM (SELECT *, {_part('tote_key')} AS part,
            routed_date IS NULL AND tote_key IS NOT NULL AND id % 101 = 0 AS answered FROM tote_router)
        GROUP BY part""",
    ),
}

# The same results by plans that split keys and shuffle lookup tables.
for _name in ("route_reconcile", "next_state", "preroute_report_all_states", "tote_destinations"):
    ORACLE[f"{_name}_split"] = ORACLE[_name]
