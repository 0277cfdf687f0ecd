"""The same results in plain SQL, for checking. Independent of the DataFrame code on purpose."""

NODES = """
nodes AS (
WITH geo AS (
  SELECT n_nationkey AS nk, '/'||r_name AS rp, '/'||r_name||'/'||n_name AS np, r_name, n_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
base AS (
  SELECT '/' AS location_path, CAST(NULL AS STRING) AS parent_path, '/' AS name, 'folder' AS type,
         CAST(NULL AS BIGINT) AS size, CAST(NULL AS TIMESTAMP) AS last_updated, 0 AS depth_level,
         CAST(0 AS BIGINT) AS ck, CAST(0 AS BIGINT) AS fk
  UNION ALL SELECT '/EMPTY', '/', 'EMPTY', 'folder', NULL, NULL, 1, 0, 0
  UNION ALL SELECT DISTINCT rp, '/', r_name, 'folder', NULL, NULL, 1, 0, 0 FROM geo
  UNION ALL SELECT np, rp, n_name, 'folder', NULL, NULL, 2, 0, 0 FROM geo
  UNION ALL SELECT np||'/c'||CAST(c_custkey AS STRING), np, 'c'||CAST(c_custkey AS STRING),
         'folder', NULL, NULL, 3, c_custkey, 0 FROM customer JOIN geo ON c_nationkey = nk
  UNION ALL SELECT np||'/s'||CAST(s_suppkey AS STRING)||'.rec', np,
         's'||CAST(s_suppkey AS STRING)||'.rec', 'file', s_suppkey*1000003, NULL, 3, 0, s_suppkey
         FROM supplier JOIN geo ON s_nationkey = nk
  UNION ALL SELECT np||'/c'||CAST(c_custkey AS STRING)||'/o'||CAST(o_orderkey AS STRING)||'.ord',
         np||'/c'||CAST(c_custkey AS STRING), 'o'||CAST(o_orderkey AS STRING)||'.ord', 'file',
         (o_orderkey % 30)*1000003, CAST(o_orderdate AS TIMESTAMP), 4, c_custkey, o_orderkey
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = nk),
ids AS (
  SELECT CASE WHEN location_path = '/' THEN 'root' ELSE md5(location_path) END AS node_id,
         CASE WHEN parent_path = '/' THEN 'root' WHEN parent_path IS NULL THEN NULL
              ELSE md5(parent_path) END AS parent_id,
         parent_path, name, location_path, last_updated, depth_level, size, type, ck, fk FROM base)
SELECT 'primary' AS world, node_id, parent_id, parent_path, name, location_path, last_updated,
       depth_level, size, type FROM ids
UNION ALL
SELECT 's1', node_id, parent_id, parent_path, name, location_path, last_updated, depth_level,
       CASE WHEN fk % 7 = 1 THEN size + 1 ELSE size END, type FROM ids
WHERE (ck = 0 OR ck % 3 <> 0) AND (fk = 0 OR fk % 5 <> 0)
)"""

# The tree of world primary mounted at /data, and a little outside of it.
LOCAL = NODES + """,
mounted AS (
  SELECT 'local' AS world,
    '/data'||CASE WHEN location_path = '/' THEN '' ELSE location_path END AS node_id,
    CASE WHEN location_path = '/' THEN '/' WHEN parent_path = '/' THEN '/data'
         ELSE '/data'||parent_path END AS parent_id,
    parent_path, CASE WHEN location_path = '/' THEN 'data' ELSE name END AS name, location_path,
    last_updated, depth_level, size, type
  FROM nodes WHERE world = 'primary'
  UNION ALL SELECT 'local', '/', NULL, '/', '/', '/', NULL, 0, NULL, 'folder'
  UNION ALL SELECT 'local', '/database', '/', '/', 'database', '/', NULL, 1, NULL, 'folder'
  UNION ALL SELECT 'local', '/database/x', '/database', '/', 'x', '/', NULL, 2, 10, 'file'),
allnodes AS (SELECT * FROM nodes UNION ALL SELECT * FROM mounted)"""

# Positions by one plain window per folder.
NUMBERED = """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY world, parent_id
      ORDER BY CASE WHEN type = 'file' THEN 1 ELSE 0 END, name, node_id) - 1 AS idx,
    count(*) OVER (PARTITION BY world, parent_id) AS total,
    count(*) FILTER (type = 'folder') OVER (PARTITION BY world, parent_id) AS total_folders
  FROM {table} WHERE parent_id IS NOT NULL)"""

NODE_OUT = """world, node_id, parent_id, parent_path, name, location_path,
  strftime(last_updated, '%Y-%m-%dT%H:%M:%SZ') AS last_updated,
  CAST(depth_level AS BIGINT) AS depth_level, CAST(size AS BIGINT) AS size, type"""

EVENT_PATHS = """,
geo AS (SELECT n_nationkey AS nk, '/'||r_name||'/'||n_name AS np
  FROM nation JOIN region ON n_regionkey = r_regionkey),
event_paths AS (
  SELECT event_id AS e, user_id AS u, n.np AS nation_path, c.np||'/c'||c_custkey AS customer_path,
    s.np||'/s'||s_suppkey||'.rec' AS file_path,
    event_id % 61 - 5 AS "offset",
    CASE event_id // 8 % 6 WHEN 0 THEN -1 WHEN 1 THEN 0 WHEN 2 THEN 7 WHEN 3 THEN 50
      WHEN 4 THEN 1000 ELSE 5000 END AS "limit",
    event_id // 48 % 2 = 0 AS folders_only
  FROM events
  LEFT JOIN geo n ON n.nk = user_id % 25
  LEFT JOIN (customer JOIN geo ON c_nationkey = nk) c ON c_custkey = user_id
  LEFT JOIN (supplier JOIN geo ON s_nationkey = nk) s ON s_suppkey = user_id)"""

CLAMPED = """CAST(greatest("offset", 0) AS BIGINT) AS off, CAST(CASE WHEN "limit" <= 0 THEN 100
  WHEN "limit" > 1000 THEN 1000 ELSE "limit" END AS BIGINT) AS lim"""

FOLDER_REQUESTS = EVENT_PATHS + f""",
asked AS (
  SELECT e AS request_id, CASE WHEN e % 3 = 0 THEN 's1' ELSE 'primary' END AS world,
    coalesce(CASE e // 96 % 5 WHEN 0 THEN md5(nation_path) WHEN 1 THEN md5(customer_path)
      WHEN 2 THEN md5(file_path) WHEN 3 THEN 'root' ELSE 'missing' END, 'missing') AS parent_id,
    folders_only, {CLAMPED}
  FROM event_paths)"""


def _clean(column: str) -> str:
    """POSIX clean of a column (which must be a plain column name)."""
    body = f"""array_to_string(list_reduce(
      list_transform(list_filter(string_split({column}, '/'), lambda s: s <> '' AND s <> '.'),
        lambda s: [s]),
      lambda a, x: CASE WHEN x[1] <> '..' THEN a || x
        WHEN len(a) > 0 AND a[len(a)] <> '..' THEN a[1:len(a)-1]
        WHEN starts_with({column}, '/') THEN a ELSE a || x END,
      CAST([] AS VARCHAR[])), '/')"""
    return f"""CASE WHEN starts_with({column}, '/') THEN '/' || {body}
      WHEN {body} = '' THEN '.' ELSE {body} END"""


def _slashed(column: str) -> str:
    """Trimmed, with forward slashes and a leading slash; a plain expression."""
    space = r"[\s\x{0B}\x{85}\p{Z}]"
    trimmed = (
        f"regexp_replace(regexp_replace({column}, '^{space}+', ''), '{space}+$', '')"
    )
    slashed = f"replace({trimmed}, '\\', '/')"
    return f"CASE WHEN starts_with({slashed}, '/') THEN {slashed} ELSE '/' || {slashed} END"


# Paths spelt in odd ways: seven spellings by length, and edge cases.
RAW_PATHS = NODES + r""",
edges AS (SELECT unnest(['', '   ', '/', '//a///b/', 'a/b', '\a\b', 'a\..\b', '/../../x', './a/./b',
  '/a/../..', '...', '/.../x', 'a/../../b', '../..', chr(9)||'/t'||chr(9), chr(160)||'n'||chr(12288),
  chr(8203)||'z', '/é/ü', '/home/user2/x', 'a/', '\', '/a\/b']) AS p),
raw AS (
  SELECT 'edge' AS world, p AS node_id, p AS location_path, p AS parent_path FROM edges
  UNION ALL
  SELECT world, node_id, CASE length(location_path) % 7
      WHEN 0 THEN location_path WHEN 1 THEN replace(location_path, '/', '//')
      WHEN 2 THEN replace(location_path, '/', '\') WHEN 3 THEN '  '||location_path||chr(9)
      WHEN 4 THEN '/x/..'||location_path||'/' WHEN 5 THEN 'x/../..'||location_path||'/./y/..'
      ELSE substr(location_path, 2) END, parent_path FROM nodes)"""

DOCS = """
docfiles AS (
  SELECT w.world, doc_id, '/'||source||'/'||lang||'/'||doc_id||'.txt' AS location_path,
    CASE WHEN w.world = 's1' AND doc_id % 5 = 1 THEN text||' old' ELSE text END AS text
  FROM documents JOIN (VALUES ('primary'), ('s1')) w(world) ON w.world = 'primary' OR doc_id % 3 <> 0),
files AS (
  SELECT world, doc_id, md5(location_path) AS node_id, location_path,
    regexp_replace(location_path, '/[^/]*$', '') AS parent_path, doc_id||'.txt' AS name,
    octet_length(encode(text)) AS size, md5(text) AS digest FROM docfiles),
folders AS (
  SELECT DISTINCT world, '/' AS location_path FROM files
  UNION SELECT world, '/'||split_part(location_path, '/', 2) FROM files
  UNION SELECT world, parent_path FROM files)"""

SERVICES = """
raw_services AS (
  SELECT * FROM (VALUES
    ('local-main', 'Main Local Storage', 'local', '/data', '', '', '', 1),
    ('local-open', '', 'local', '', '', '', '', 2), ('local-dup', 'Old', 'local', '/old', '', '', '', 3),
    ('local-dup', 'New', 'local', '/new', '', '', '', 4),
    ('cat-primary', '', 'catalog', '', '', '', '/etc/cat.json', 5),
    ('cat-s1', '', 'catalog', '', 's1', '', '/etc/cat.json', 6),
    ('', 'no id', 'local', '', '', '', '', 7), ('cat-bare', '', 'catalog', '', '', '', '', 8))
    t(service_id, name, kind, root_path, world, root_id, config_path, load_order)
  UNION ALL
  SELECT 'svc-'||(k // 2), CASE WHEN k % 4 = 0 THEN '' ELSE s_name END,
    CASE WHEN k % 3 = 0 THEN 'catalog' ELSE 'local' END,
    CASE WHEN k % 3 = 1 THEN '/data'||'/'||r_name||'/'||n_name WHEN k % 11 = 2 THEN 'relative/root'
      ELSE '' END,
    CASE WHEN k % 2 = 0 THEN 's1' ELSE '' END, CASE WHEN k % 5 = 0 THEN 'top' ELSE '' END,
    CASE WHEN k % 7 = 0 THEN '' ELSE '/etc/cat'||k||'.json' END, k + 100
  FROM (SELECT *, s_suppkey AS k FROM supplier) JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
judged AS (
  SELECT *, CASE WHEN service_id = '' THEN 'missing_id'
    WHEN kind = 'catalog' AND config_path = '' THEN 'missing_config_path'
    WHEN kind = 'catalog' AND config_path NOT LIKE '/%' THEN 'invalid_path'
    WHEN kind = 'local' AND root_path <> '' AND root_path NOT LIKE '/%' THEN 'invalid_path'
    ELSE 'ok' END AS status FROM raw_services),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY service_id, status
    ORDER BY kind <> 'local' DESC, load_order DESC) AS rn FROM judged),
dimension AS (
  SELECT service_id, CASE WHEN name = '' THEN service_id ELSE name END AS name, kind,
    CASE WHEN kind = 'local' AND root_path <> '' THEN root_path END AS root_path,
    CASE WHEN kind = 'catalog' THEN CASE WHEN world = '' THEN 'primary' ELSE world END END AS world,
    CASE WHEN kind = 'catalog' THEN CASE WHEN root_id = '' THEN 'root' ELSE root_id END END AS root_id,
    CASE WHEN kind = 'catalog' AND config_path <> '' THEN config_path END AS config_path,
    CAST(load_order AS BIGINT) AS load_order, status
  FROM ranked WHERE status <> 'ok' OR rn = 1),
services AS (SELECT * FROM dimension WHERE status = 'ok')"""

ROUTED = LOCAL + "," + SERVICES + """,
sessions AS (SELECT * FROM (VALUES ('sess-ok', 'catalog', 'open'),
  ('sess-closed', 'catalog', 'closed'), ('sess-local', 'local', 'open')) t(sid, skind, state))""" + EVENT_PATHS + f""",
req0 AS (
  SELECT e AS request_id,
    CASE e % 8 WHEN 2 THEN 'local' WHEN 3 THEN 'cat-primary' WHEN 4 THEN 'cat-s1'
      WHEN 5 THEN 'local-main' WHEN 6 THEN 'no-such' ELSE 'catalog' END AS service_id,
    CASE u % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'destination' ELSE '' END AS role,
    CASE u % 7 WHEN 3 THEN 'sess-closed' WHEN 4 THEN '' WHEN 5 THEN 'no-such-session'
      WHEN 6 THEN 'sess-local' ELSE 'sess-ok' END AS session_id,
    e // 96 % 5 AS what, e // 480 % 4 AS odd,
    CASE e // 96 % 5 WHEN 0 THEN nation_path WHEN 1 THEN customer_path WHEN 2 THEN file_path END AS path,
    folders_only, {CLAMPED}
  FROM event_paths),
req AS (
  SELECT *, coalesce(CASE WHEN what = 3 THEN ''
    WHEN what = 4 AND service_id IN ('local', 'local-main') THEN
      CASE odd WHEN 0 THEN 'missing' WHEN 1 THEN '/database/x' WHEN 2 THEN '/' ELSE '/data/missing' END
    WHEN what = 4 THEN 'missing'
    WHEN service_id IN ('local', 'local-main') THEN '/data'||path
    ELSE md5(path) END, 'missing') AS identifier,
    CASE service_id
      WHEN 'catalog' THEN (SELECT min(service_id) FROM services s WHERE kind = 'catalog'
        AND s.world = CASE WHEN role = 'destination' THEN 's1' ELSE 'primary' END)
      WHEN 'local' THEN (SELECT min(service_id) FROM services WHERE kind = 'local')
      ELSE service_id END AS wanted FROM req0),
joined AS (
  SELECT r.*, s.service_id AS served_by, s.kind, s.root_id, s.config_path, skind, state, sid,
    CASE WHEN r.service_id <> 'local' THEN s.root_path END AS root,
    CASE WHEN s.kind = 'local' THEN 'local' ELSE s.world END AS world
  FROM req r LEFT JOIN services s ON s.service_id = wanted LEFT JOIN sessions ON sid = session_id),
aimed AS (
  SELECT *, CASE WHEN kind = 'local' THEN CASE WHEN identifier <> '' THEN identifier
      ELSE coalesce(root, '/') END
    WHEN kind = 'catalog' THEN CASE WHEN identifier <> '' THEN identifier ELSE root_id END END AS target
  FROM joined),
resolved AS (
  SELECT *, CASE WHEN served_by IS NULL AND service_id = 'catalog' THEN 'world_not_found'
    WHEN served_by IS NULL AND service_id = 'local' THEN 'no_local_service'
    WHEN served_by IS NULL THEN 'service_not_found'
    WHEN kind = 'catalog' AND session_id = '' THEN 'session_required'
    WHEN kind = 'catalog' AND sid IS NULL THEN 'session_not_found'
    WHEN kind = 'catalog' AND skind <> 'catalog' THEN 'session_wrong_kind'
    WHEN kind = 'catalog' AND state <> 'open' THEN 'session_closed'
    WHEN kind = 'local' AND target NOT LIKE '/%' THEN 'invalid_path'
    WHEN kind = 'local' AND root IS NOT NULL AND target <> root AND NOT starts_with(target, root||'/')
      THEN 'outside_root'
    ELSE 'ok' END AS status FROM aimed),
checked AS (
  SELECT r.* REPLACE (CASE WHEN r.status <> 'ok' THEN r.status WHEN n.node_id IS NULL THEN 'not_found'
    WHEN n.type <> 'folder' THEN 'not_folder' ELSE 'ok' END AS status)
  FROM resolved r LEFT JOIN allnodes n ON n.world = r.world AND n.node_id = r.target)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _relocated(root: str, compat: bool) -> str:
    inside = f"starts_with(parent_id, '{root}')" if compat else (
        f"(parent_id = '{root}' OR starts_with(parent_id, '{root}/'))"
    )
    parent = (
        f"CASE WHEN {inside} THEN '/'||ltrim(substr(parent_id, {len(root) + 1}), '/') ELSE '/' END"
    )
    return _with(LOCAL) + f""", moved AS (SELECT *, {parent} AS pp FROM mounted WHERE parent_id IS NOT NULL)
      SELECT node_id, pp AS parent_path, CASE WHEN pp = '/' THEN '' ELSE pp END||'/'||name AS location_path
      FROM moved"""


RELOCATE_ROOT = "/data/AMERICA/NATION_1"

SKEWED = NODES + """,
skewed AS (SELECT * REPLACE (CASE WHEN type = 'file' AND size % 3 = 0 THEN 'hot' ELSE parent_id END
  AS parent_id) FROM nodes)""" + NUMBERED.format(table="skewed")

WANTED_FOLDERS = NODES + """,
wanted AS (
  SELECT 'primary' AS world, parent_path||'/new'||length(name)||'/'||name AS path, 0 AS blocked
    FROM nodes WHERE world = 'primary' AND depth_level = 3
  UNION ALL SELECT 'primary', location_path||'/sub', 1 FROM nodes
    WHERE world = 'primary' AND type = 'file'
  UNION ALL SELECT 's1', location_path, 0 FROM nodes WHERE world = 'primary' AND type = 'folder'
  UNION ALL SELECT host, rtrim(path, '/'), 0 FROM (
    SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
      regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages))"""

COMMITS = DOCS + """,
handles AS (SELECT doc_id, text, '/'||source||'/'||lang AS folder,
    CASE WHEN doc_id % 10 = 3 THEN doc_id||'.txt' ELSE 'new-'||doc_id END AS name,
    doc_id % 9 <> 2 AS is_staged, doc_id % 10 = 3 AS taken FROM documents),
attempts AS (
  SELECT *, 0 AS seq, CASE WHEN doc_id % 6 = 1 THEN '' ELSE text END AS data FROM handles
  UNION ALL SELECT *, 1, text||' again' FROM handles WHERE doc_id % 4 = 0 OR doc_id % 6 = 1),
judged AS (
  SELECT *, CASE WHEN NOT is_staged THEN 'not_staged' WHEN data = '' THEN 'empty_data'
    WHEN taken THEN 'already_exists'
    WHEN seq <> min(seq) FILTER (data <> '') OVER (PARTITION BY doc_id) THEN 'no_op'
    ELSE 'committed' END AS status FROM attempts)"""

OVERWRITES = DOCS + """,
primary_files AS (SELECT f.node_id, f.digest, f.size, d.doc_id, f.parent_path, d.text
  FROM files f JOIN documents d USING (doc_id) WHERE world = 'primary'),
writes AS (
  SELECT CASE WHEN doc_id % 7 = 0 THEN 'gone-'||doc_id ELSE node_id END AS node_id, 0 AS seq,
    'UP:'||text AS data FROM primary_files
  UNION ALL SELECT node_id, 1, CASE WHEN doc_id % 6 = 0 THEN '' ELSE text||'!' END FROM primary_files
    WHERE doc_id % 3 = 0
  UNION ALL SELECT md5(parent_path), doc_id + 2, text FROM primary_files),
judged AS (SELECT *, CASE WHEN node_id NOT IN (SELECT node_id FROM primary_files)
      THEN CASE WHEN seq > 1 THEN 'not_file' ELSE 'not_found' END
    WHEN seq <> max(seq) OVER (PARTITION BY node_id) THEN 'superseded' ELSE 'written' END AS status
  FROM writes)"""


def oracle_sql() -> dict[str, str]:
    page = 25
    window_rows = f"""SELECT request_id, idx, {NODE_OUT} FROM asked JOIN numbered
      USING (world, parent_id) WHERE idx >= off AND idx < off + lim
      AND (NOT folders_only OR type = 'folder')"""
    info_columns = """off AS "offset", lim AS "limit", coalesce(total, 0) AS total,
      coalesce(total_folders, 0) AS total_folders,
      coalesce(total, 0) - coalesce(total_folders, 0) AS total_files,
      off + lim < coalesce(total, 0) AS has_more"""
    counts = """, counts AS (SELECT world, parent_id, count(*) AS total,
      count(*) FILTER (type = 'folder') AS total_folders FROM {table} GROUP BY ALL)"""
    doc_nodes = f"""SELECT world, CASE WHEN location_path = '/' THEN 'root' ELSE md5(location_path) END
      AS node_id, location_path, 'folder' AS type, NULL AS size FROM folders
      UNION ALL SELECT world, node_id, location_path, 'file', size FROM files"""
    parent_of = """CASE WHEN location_path = '/' THEN NULL
      WHEN regexp_replace(location_path, '/[^/]*$', '') = '' THEN '/'
      ELSE regexp_replace(location_path, '/[^/]*$', '') END"""
    raw_clean = RAW_PATHS + f""", slashed AS (SELECT world, node_id, {_slashed('location_path')} AS lp,
      parent_path, {_slashed("coalesce(parent_path, '')")} AS pp,
      trim(coalesce(parent_path, ''), ' ') AS blank FROM raw)"""
    copied = """, plan AS (SELECT a.location_path, a.node_id, a.size, a.digest, b.size AS dst_size,
      CASE WHEN b.node_id IS NULL THEN 'copy' WHEN a.size <> b.size THEN 'overwrite' ELSE 'skip' END
      AS action FROM (SELECT * FROM files WHERE world = 'primary') a
      LEFT JOIN (SELECT * FROM files WHERE world = 's1') b ON a.location_path = b.location_path)"""
    sql = {
        "flagship": _with(NODES) + NUMBERED.format(table="nodes") + f"""
          SELECT idx, total, 13 < total AS has_more, {NODE_OUT} FROM numbered
          WHERE world = 'primary' AND idx >= 3 AND idx < 13
            AND parent_id IN (SELECT node_id FROM nodes WHERE world = 'primary' AND depth_level = 2
              AND type = 'folder')""",
        "scan_tree": _with(DOCS) + f"""SELECT {parent_of} AS parent_path,
            regexp_extract(location_path, '[^/]*$') AS name, location_path,
            CAST(len(location_path) - len(replace(location_path, '/', '')) AS BIGINT) AS depth_level,
            CAST(size AS BIGINT) AS size, type FROM ({doc_nodes})
          WHERE world = 'primary' AND location_path <> '/'""",
        "scan_nodes": _with(NODES) + f"SELECT {NODE_OUT} FROM nodes WHERE world = 's1'",
        "write_nodes": _with(LOCAL) + f"SELECT {NODE_OUT} FROM allnodes",
        "read_content": _with(DOCS) + """SELECT a.world, a.node_id,
            CASE WHEN f.node_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
            CAST(f.size AS BIGINT) AS bytes, f.digest
          FROM (SELECT w.world, node_id FROM files JOIN (VALUES ('primary'), ('s1')) w(world)
            ON files.world = 'primary') a
          LEFT JOIN files f ON f.world = a.world AND f.node_id = a.node_id""",
        "write_tree": _with(DOCS) + """SELECT location_path, CAST(size AS BIGINT) AS size,
            'written' AS status, digest FROM files WHERE world = 'primary'""",
        "copy_tree": _with(DOCS) + """SELECT location_path, CAST(size AS BIGINT) AS size,
            'written' AS status, digest FROM files WHERE world = 'primary'""",
        "bulk_copy": _with(DOCS) + copied + """SELECT location_path, 'file' AS type,
            CAST(size AS BIGINT) AS size, digest FROM plan WHERE action IN ('copy', 'overwrite')
            AND size > 0
          UNION ALL SELECT location_path, 'folder', NULL, NULL FROM folders WHERE world = 'primary'
            AND location_path NOT IN (SELECT location_path FROM folders WHERE world = 's1')""",
        "bulk_copy_status": _with(DOCS) + copied + """SELECT location_path, action,
            CASE action WHEN 'copy' THEN 'copied' WHEN 'overwrite' THEN 'overwritten' ELSE 'skipped'
            END AS status FROM plan""",
        "normalize_nodes": _with(raw_clean) + f"""SELECT world, node_id, {_clean('lp')} AS location_path,
            CASE WHEN parent_path IS NULL THEN NULL WHEN blank = '' THEN '' ELSE {_clean('pp')} END
            AS parent_path FROM slashed""",
        "normalize_collisions": _with(raw_clean) + f"""SELECT * FROM (SELECT 'all' AS world,
            {_clean('lp')} AS location_path, count(*) AS copies FROM slashed GROUP BY ALL)
          WHERE copies > 1""",
        "normalize_physical": _with(RAW_PATHS) + f"""SELECT world, node_id, location_path AS p,
            regexp_replace(replace({_clean('location_path')}, '\\', '/'), '/$', '') AS physical
          FROM raw""",
        "relocate_nodes": _relocated(RELOCATE_ROOT, False),
        "relocate_nodes_compat": _relocated(RELOCATE_ROOT, True),
        "child_paths": _with(LOCAL) + """SELECT parent_id, name,
            CASE WHEN location_path = '/' THEN '/'||name ELSE location_path END
            AS location_path, node_id AS physical_path FROM mounted
          WHERE parent_id IS NOT NULL""",
        "root_guard": _with(LOCAL) + f"""SELECT node_id AS path, ok AS allowed,
            CASE WHEN NOT ok THEN 'path '||node_id||' is outside allowed root {RELOCATE_ROOT}' END
            AS violation FROM (SELECT node_id, node_id = '{RELOCATE_ROOT}'
              OR starts_with(node_id, '{RELOCATE_ROOT}/') AS ok FROM mounted)""",
        "world_filter": _with(NODES) + f"SELECT {NODE_OUT} FROM nodes WHERE world = 'primary'",
        "folders_only": _with(NODES) + f"SELECT {NODE_OUT} FROM nodes WHERE type = 'folder'",
        "classify_entries": _with(LOCAL) + """SELECT world, node_id, parent_id,
            CASE WHEN location_path = '/' OR node_id LIKE '/database%' THEN '/' ELSE parent_path END
            AS parent_path, name,
            CASE WHEN location_path = '/' THEN '/'||name ELSE location_path END AS location_path,
            strftime(last_updated, '%Y-%m-%dT%H:%M:%SZ') AS last_updated,
            CAST(CASE WHEN location_path = '/' THEN 1 ELSE depth_level END AS BIGINT) AS depth_level,
            CAST(size AS BIGINT) AS size, type FROM mounted WHERE parent_id IS NOT NULL""",
        "format_nodes": _with(NODES) + f"SELECT {NODE_OUT} FROM nodes",
        "with_depth": _with(NODES) + """SELECT world, node_id,
            CAST(depth_level AS BIGINT) AS depth_level FROM nodes""",
        "validate_parents": _with(NODES) + FOLDER_REQUESTS + """SELECT request_id, a.world, a.parent_id,
            CASE WHEN n.node_id IS NULL THEN 'not_found' WHEN type <> 'folder' THEN 'not_folder'
              ELSE 'ok' END AS status,
            CASE WHEN n.node_id IS NULL THEN 'node '||a.parent_id||' not found'
              WHEN type <> 'folder' THEN 'node '||a.parent_id||' is not a folder' END AS message
          FROM asked a LEFT JOIN nodes n ON n.world = a.world AND n.node_id = a.parent_id""",
        "list_children": _with(NODES) + FOLDER_REQUESTS + f"""SELECT request_id, {NODE_OUT}
          FROM asked JOIN nodes USING (world, parent_id)""",
        "children_once": _with(NODES) + FOLDER_REQUESTS + f""",
          folders AS (SELECT request_id, a.world, a.parent_id FROM asked a
            JOIN nodes n ON n.world = a.world AND n.node_id = a.parent_id AND n.type = 'folder')
          SELECT request_id, {NODE_OUT} FROM (
            SELECT NULL AS request_id, n.* FROM nodes n
              WHERE (world, parent_id) IN (SELECT (world, parent_id) FROM folders)
            UNION ALL BY NAME SELECT * FROM folders)""",
        "child_counts": _with(NODES) + counts.format(table="nodes") + """SELECT n.world, n.node_id,
            coalesce(total, 0) AS total, coalesce(total_folders, 0) AS total_folders,
            coalesce(total, 0) - coalesce(total_folders, 0) AS total_files
          FROM nodes n LEFT JOIN counts c ON c.world = n.world AND c.parent_id = n.node_id
          WHERE type = 'folder'""",
        "name_order": _with(NODES) + NUMBERED.format(table="nodes") + f"""
          SELECT idx, {NODE_OUT} FROM numbered""",
        "name_order_skewed": _with(SKEWED) + f" SELECT idx, {NODE_OUT} FROM numbered",
        "page_children_skewed": _with(SKEWED) + f"""SELECT {NODE_OUT}, idx,
            CAST(idx // 100 AS BIGINT) AS page, CAST(100 AS BIGINT) AS page_size, total,
            (idx // 100 + 1) * 100 < total AS has_more FROM numbered""",
        "page_children": _with(NODES) + NUMBERED.format(table="nodes") + f"""SELECT {NODE_OUT}, idx,
            CAST(idx // {page} AS BIGINT) AS page, CAST({page} AS BIGINT) AS page_size, total,
            (idx // {page} + 1) * {page} < total AS has_more FROM numbered""",
        "window_children": _with(NODES) + NUMBERED.format(table="nodes") + FOLDER_REQUESTS + window_rows,
        "page_info": _with(NODES) + FOLDER_REQUESTS + counts.format(table="nodes") + f"""
          SELECT request_id, {info_columns} FROM asked LEFT JOIN counts USING (world, parent_id)""",
        "as_nodes": _with(NODES) + f"SELECT {NODE_OUT} FROM nodes",
        "split_nodes": _with(NODES) + """SELECT type AS part, count(*) AS rows,
            CAST(sum(size) AS BIGINT) AS bytes FROM nodes GROUP BY type""",
        "service_dimension": _with(SERVICES) + "SELECT * FROM dimension",
        "resolve_requests": _with(ROUTED) + """SELECT request_id, service_id, served_by, kind, root,
            world, target, status FROM resolved""",
        "serve_listing": _with(ROUTED) + NUMBERED.format(table="allnodes") + f""",
          cut AS (SELECT c.request_id, c.kind, coalesce(c.root, '/') AS r, n.* FROM checked c
            JOIN numbered n ON n.world = c.world AND n.parent_id = c.target
            WHERE c.status = 'ok' AND idx >= off AND idx < off + lim
              AND (NOT folders_only OR type = 'folder')),
          based AS (SELECT * REPLACE (CASE WHEN kind = 'catalog' THEN parent_path
              WHEN r = '/' THEN parent_id WHEN parent_id = r THEN '/'
              ELSE substr(parent_id, length(r) + 1) END AS parent_path) FROM cut)
          SELECT request_id, idx, {NODE_OUT.replace(' location_path,',
            " CASE WHEN kind = 'catalog' THEN location_path WHEN parent_path = '/' THEN '/'||name "
            "ELSE parent_path||'/'||name END AS location_path,")} FROM based""",
        "serve_listing_info": _with(ROUTED) + counts.format(table="allnodes") + f"""
          SELECT request_id, served_by, status, i."offset", i."limit", i.total, i.total_folders,
            i.total_files, i.has_more
          FROM checked LEFT JOIN (SELECT request_id, {info_columns} FROM checked c
            LEFT JOIN counts k ON k.world = c.world AND k.parent_id = c.target
            WHERE status = 'ok') i USING (request_id)""",
        "list_sources": _with(LOCAL, SERVICES) + """,
          sources AS (
            SELECT service_id AS id, name AS display_name, kind,
              'name='||name||CASE WHEN root_path IS NULL THEN '' ELSE ',rootPath='||root_path END
              AS metadata, coalesce(root_path, '') AS r FROM services WHERE kind = 'local'),
          catalog AS (SELECT 'configPath='||arg_min(config_path, service_id)||',name=Catalog' AS metadata
            FROM services WHERE kind = 'catalog' HAVING count(*) > 0),
          sums AS (SELECT id, display_name, kind, metadata,
              count(*) FILTER (type = 'folder') AS folders, count(*) FILTER (type = 'file') AS files,
              CAST(coalesce(sum(size), 0) AS BIGINT) AS bytes
            FROM sources LEFT JOIN mounted ON mounted.parent_id = CASE WHEN r = '' THEN '/' ELSE r END
              OR starts_with(mounted.parent_id, r||'/')
            GROUP BY ALL)
          SELECT id, display_name, kind, metadata, folders, files, bytes FROM sums
          UNION ALL SELECT 'catalog', 'Catalog', 'catalog', metadata,
            (SELECT count(*) FILTER (type = 'folder') FROM nodes WHERE parent_id IS NOT NULL),
            (SELECT count(*) FILTER (type = 'file') FROM nodes WHERE parent_id IS NOT NULL),
            (SELECT CAST(sum(size) AS BIGINT) FROM nodes) FROM catalog""",
        "copy_plan": _with(NODES) + """SELECT a.location_path, a.node_id, a.size,
            b.node_id AS dst_node_id, b.size AS dst_size,
            CASE WHEN b.node_id IS NULL THEN 'copy' WHEN a.size <> b.size THEN 'overwrite' ELSE 'skip'
            END AS action
          FROM (SELECT * FROM nodes WHERE world = 'primary' AND type = 'file') a
          LEFT JOIN (SELECT * FROM nodes WHERE world = 's1') b ON a.location_path = b.location_path""",
        "chunk_plan": _with(NODES) + """SELECT world, node_id, CAST(i AS BIGINT) AS chunk_no,
            CAST(i * 8388608 AS BIGINT) AS start_byte,
            CAST(least(8388608, size - i * 8388608) AS BIGINT) AS length
          FROM (SELECT world, node_id, size, unnest(range(0, greatest((size + 8388607) // 8388608, 1))) AS i
            FROM nodes WHERE type = 'file')""",
        "buffer_class": _with(NODES) + """SELECT CASE WHEN size > 10485760 THEN 'spill' ELSE 'memory' END
            AS class, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
          FROM nodes WHERE type = 'file' GROUP BY 1""",
        "create_folders": _with(WANTED_FOLDERS) + """,
          steps AS (SELECT DISTINCT world, '/'||array_to_string(segs[1:i], '/') AS path FROM (
            SELECT world, segs, unnest(range(1, len(segs) + 1)) AS i FROM (
              SELECT world, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs FROM wanted
              WHERE blocked = 0))
            UNION SELECT world, '/' FROM wanted WHERE blocked = 0),
          made AS (SELECT * FROM steps s WHERE NOT EXISTS (SELECT 1 FROM nodes n
            WHERE n.world = s.world AND n.location_path = s.path)),
          parts AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS head FROM made)
          SELECT world, CASE WHEN path = '/' THEN 'root' ELSE md5(path) END AS node_id,
            CASE WHEN path = '/' THEN NULL WHEN head = '' THEN 'root' ELSE md5(head) END AS parent_id,
            CASE WHEN path = '/' THEN NULL WHEN head = '' THEN '/' ELSE head END AS parent_path,
            CASE WHEN path = '/' THEN '/' ELSE regexp_extract(path, '[^/]*$') END AS name,
            path AS location_path,
            CAST(CASE WHEN path = '/' THEN 0 ELSE len(path) - len(replace(path, '/', '')) END AS BIGINT)
              AS depth_level FROM parts""",
        "create_folders_status": _with(WANTED_FOLDERS) + """
          SELECT DISTINCT w.world, CASE WHEN path = '' THEN '/' ELSE path END AS path,
            CASE WHEN blocked = 1 THEN 'not_folder' WHEN n.node_id IS NOT NULL THEN 'exists'
              ELSE 'created' END AS status
          FROM wanted w LEFT JOIN nodes n ON n.world = w.world AND n.location_path = w.path""",
        "commit_files": _with(COMMITS) + """SELECT md5(folder||'/'||name) AS node_id,
            folder||'/'||name AS location_path, CAST(octet_length(encode(data)) AS BIGINT) AS size,
            md5(data) AS digest FROM judged WHERE status = 'committed'""",
        "commit_files_status": _with(COMMITS) + """SELECT folder||'/'||name AS path,
            CAST(seq AS BIGINT) AS commit_seq, status FROM judged""",
        "overwrite_files": _with(OVERWRITES) + """SELECT f.world, f.node_id,
            CAST(coalesce(octet_length(encode(data)), f.size) AS BIGINT) AS size,
            CASE WHEN data IS NULL THEN f.digest ELSE md5(data) END AS digest
          FROM files f LEFT JOIN judged j
            ON f.world = 'primary' AND j.node_id = f.node_id AND status = 'written'""",
        "overwrite_files_status": _with(OVERWRITES) + """SELECT node_id,
            CAST(seq AS BIGINT) AS write_seq, status FROM judged""",
        "source_order": "",
        "stage_files": _with(NODES) + """,
          wanted AS (SELECT world, CASE WHEN length(name) % 5 = 0 THEN node_id
              WHEN length(name) % 7 = 0 THEN 'gone' ELSE parent_id END AS parent_id,
            'new:'||name AS name, size, location_path AS meta FROM nodes WHERE type = 'file')
          SELECT 'pending:'||w.parent_id||':'||w.name AS pending_id, w.world, w.parent_id,
            p.location_path AS parent_path, w.name,
            CASE WHEN p.location_path = '/' THEN '/'||w.name ELSE p.location_path||'/'||w.name END
              AS location_path, w.size, CAST(p.depth_level + 1 AS BIGINT) AS depth_level,
            'from='||meta AS metadata,
            CASE WHEN p.node_id IS NULL THEN 'not_found' WHEN p.type <> 'folder' THEN 'not_folder'
              ELSE 'staged' END AS status
          FROM wanted w LEFT JOIN nodes p ON p.world = w.world AND p.node_id = w.parent_id""",
        "decode_pending": _with(NODES) + """,
          ids AS (SELECT CASE length(name) % 4 WHEN 0 THEN 'pending:'||parent_id||':'||name
              WHEN 1 THEN 'pending:'||parent_id||':v1:'||name WHEN 2 THEN 'pending:'||parent_id
              ELSE parent_id||':'||name END AS pending_id FROM nodes WHERE parent_id IS NOT NULL)
          SELECT pending_id, CASE WHEN good THEN split_part(pending_id, ':', 2) END AS parent_id,
            CASE WHEN good THEN substr(pending_id, length(split_part(pending_id, ':', 2)) + 10) END
              AS name,
            CASE WHEN NOT starts_with(pending_id, 'pending:') THEN 'not_pending'
              WHEN NOT good THEN 'bad_format' ELSE 'ok' END AS status
          FROM (SELECT *, starts_with(pending_id, 'pending:')
            AND len(string_split(pending_id, ':')) >= 3 AS good FROM ids)""",
    }
    sql["source_order"] = f"SELECT id, display_name FROM ({sql['list_sources']})"
    return sql
