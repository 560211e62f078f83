"""Common table expressions of the SQL twins."""

# Lines of the DNS log as the adapter builds them, and the valid ones.
DNS = r"""
dns_log AS (
  SELECT e.event_id AS logline_id, e.ts, e.event_type,
    CASE WHEN e.event_id % 13 = 0 THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f')
         ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts_text,
    CASE e.event_type WHEN 'error' THEN 'NXDOMAIN' WHEN 'signup' THEN 'SERVFAIL' ELSE 'NOERROR' END AS status_code,
    '192.168.' || CAST(e.user_id % 4 AS VARCHAR) || '.' || CAST(1 + e.user_id % 254 AS VARCHAR) AS src_ip,
    '10.10.0.' || CASE WHEN e.event_id % 17 = 0 THEN '300' ELSE CAST(1 + e.event_id % 10 AS VARCHAR) END AS dns_server_ip,
    CASE WHEN e.event_id % 19 = 0 THEN '-' ELSE '' END
      || replace(regexp_extract(p.url, '://([^/?#:]+)', 1), '.example.', '.') AS domain_name,
    CASE WHEN e.event_id % 7 = 0 THEN 'CNAME' WHEN e.event_id % 2 = 0 THEN 'A' ELSE 'AAAA' END AS record_type,
    CAST(CAST(floor(e.value) AS BIGINT) AS VARCHAR) || CASE WHEN e.event_id % 11 = 0 THEN 'b' ELSE '' END AS size
  FROM events e, (SELECT count(*) AS n FROM pages) c JOIN pages p ON e.event_id % c.n = p.page_id
),
checked AS (
  SELECT *,
    try_strptime(ts_text, '%Y-%m-%dT%H:%M:%S.%f') IS NOT NULL AS ok_ts,
    status_code IN ('NOERROR', 'NXDOMAIN') AS ok_status_code,
    regexp_full_match(src_ip, '((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)') AS ok_src_ip,
    regexp_full_match(dns_server_ip, '((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)') AS ok_dns_server_ip,
    length(domain_name) BETWEEN 1 AND 253
      AND regexp_full_match(domain_name, '([A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}') AS ok_domain_name,
    record_type IN ('A', 'AAAA') AS ok_record_type,
    regexp_full_match(size, '\d+') AS ok_size
  FROM dns_log
),
valid_log AS (
  SELECT logline_id, ts, status_code, src_ip, dns_server_ip, domain_name, record_type, size,
    split_part(src_ip, '.', 1) || '.' || split_part(src_ip, '.', 2) || '.' || split_part(src_ip, '.', 3) || '.0_24' AS subnet_id
  FROM checked
  WHERE ok_ts AND ok_status_code AND ok_src_ip AND ok_dns_server_ip AND ok_domain_name AND ok_record_type AND ok_size
)"""


def batches(size: int, seconds: int) -> str:
    """Batches cut on size and window, and what each one is sent with."""
    return rf"""
numbered AS (
  SELECT *, CAST(floor(epoch_us(ts) / {seconds}000000.0) AS BIGINT) AS flush_no FROM valid_log
),
assigned AS (
  SELECT *,
    (row_number() OVER (PARTITION BY subnet_id, flush_no ORDER BY ts, logline_id) - 1) // {size} AS part,
    count(*) OVER (PARTITION BY subnet_id, flush_no) AS cnt
  FROM numbered
),
batch_list AS (
  SELECT subnet_id, flush_no, part, max(cnt) AS cnt, min(ts) AS lo, max(ts) AS hi, count(*) AS n,
    lag(flush_no) OVER w AS prev_flush, lag(part) OVER w AS prev_part, lag(max(cnt)) OVER w AS prev_cnt
  FROM assigned GROUP BY subnet_id, flush_no, part
  WINDOW w AS (PARTITION BY subnet_id ORDER BY flush_no, part)
),
linked AS (
  SELECT subnet_id, flush_no, part, lo, hi, n, prev_flush, prev_part,
    prev_flush = flush_no OR (prev_flush = flush_no - 1 AND prev_cnt % {size} <> 0) AS has_buffer
  FROM batch_list
),
sent AS (
  SELECT a.logline_id, a.ts, a.status_code, a.src_ip, a.domain_name, a.size, a.subnet_id, l.flush_no, l.part,
    FALSE AS is_buffer
  FROM linked l JOIN assigned a ON a.subnet_id = l.subnet_id AND a.flush_no = l.flush_no AND a.part = l.part
  UNION ALL
  SELECT a.logline_id, a.ts, a.status_code, a.src_ip, a.domain_name, a.size, a.subnet_id, l.flush_no, l.part,
    TRUE AS is_buffer
  FROM linked l JOIN assigned a ON a.subnet_id = l.subnet_id AND a.flush_no = l.prev_flush AND a.part = l.prev_part
  WHERE l.has_buffer
),
sent_lines AS (
  SELECT *, subnet_id || '#' || CAST(flush_no AS VARCHAR) || '#' || CAST(part AS VARCHAR) AS batch_id FROM sent
),
bounds AS (
  SELECT batch_id, subnet_id, flush_no, part,
    coalesce(min(ts) FILTER (WHERE is_buffer), min(ts)) AS begin_ts,
    max(ts) FILTER (WHERE NOT is_buffer) AS end_ts,
    count(*) FILTER (WHERE is_buffer) AS n_buffer, count(*) FILTER (WHERE NOT is_buffer) AS n_new
  FROM sent_lines GROUP BY batch_id, subnet_id, flush_no, part
)"""


# Lines whose names carry a hashed label, as a tunnel's would.
TUNNEL_LOG = r"""
tunnel_log AS (
  SELECT * REPLACE (CASE WHEN logline_id % 3 = 0
    THEN substr(md5(CAST(logline_id AS VARCHAR)), 1, CAST(4 + logline_id % 9 AS INTEGER)) || '.' || domain_name ELSE domain_name END AS domain_name)
  FROM valid_log
)"""


def domains(source: str = "valid_log") -> str:
    """Name parts of every line of a source."""
    return rf"""
names AS (
  SELECT *, trim(domain_name, '.') AS fqdn, string_split(trim(domain_name, '.'), '.') AS labels FROM {source}
),
split_names AS (
  SELECT *,
    CASE WHEN len(labels) >= 2 THEN labels[-2] ELSE '' END AS secondleveldomain,
    CASE WHEN len(labels) > 2 THEN array_to_string(labels[1:len(labels) - 2], '.') ELSE '' END AS thirdleveldomain
  FROM names
)"""


def entropy(text: str) -> str:
    """Shannon entropy of a text expression."""
    return (
        f"CASE WHEN length({text}) = 0 THEN 0.0 ELSE 0.0 - list_sum(list_transform(list_distinct(string_split({text}, '')), "
        f"lambda c: ((length({text}) - length(replace({text}, c, ''))) / length({text})::DOUBLE) "
        f"* log2((length({text}) - length(replace({text}, c, ''))) / length({text})::DOUBLE))) END"
    )


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def series(mode: str = "sum", where: str = "TRUE") -> str:
    """Messages, their steps and the dense series (half-hour steps)."""
    counted = {
        "sum": """counted AS (
  SELECT batch_id, step, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM in_range GROUP BY batch_id, step)""",
        "compat": """by_time AS (
  SELECT batch_id, step, ts, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM in_range GROUP BY batch_id, step, ts),
counted AS (SELECT batch_id, step, arg_max(n, ts) AS n, arg_max(bytes, ts) AS bytes FROM by_time GROUP BY batch_id, step)""",
    }[mode]
    return f"""
messages AS (
  SELECT s.*, b.begin_ts, b.end_ts FROM sent_lines s JOIN bounds b ON s.batch_id = b.batch_id WHERE {where}
),
placed AS (
  SELECT *, CAST(trunc((epoch_us(ts) - epoch_us(begin_ts)) / 1800000000.0) AS BIGINT) AS step,
    CAST(ceil((epoch_us(end_ts) - epoch_us(begin_ts)) / 1800000000.0) AS BIGINT) + 1 AS n_steps,
    CAST(replace(size, 'b', '') AS BIGINT) AS bytes
  FROM messages
),
in_range AS (SELECT * FROM placed WHERE step >= 0 AND step < n_steps),
{counted},
axis AS (
  SELECT batch_id, subnet_id, flush_no, part, unnest(range(n_steps)) AS step
  FROM (SELECT DISTINCT batch_id, subnet_id, flush_no, part, n_steps FROM placed)
),
series AS (
  SELECT a.batch_id, a.subnet_id, a.flush_no, a.part, a.step, CAST(coalesce(c.n, 0) AS DOUBLE) AS n,
    CASE WHEN c.n > 0 THEN c.bytes / c.n ELSE 0.0 END AS mean_size
  FROM axis a LEFT JOIN counted c ON a.batch_id = c.batch_id AND a.step = c.step
),
framed AS (
  SELECT *, count(*) OVER w AS c, sum(n) OVER w AS s1, sum(n * n) OVER w AS s2, list(n) OVER w AS frame
  FROM series WINDOW w AS (PARTITION BY subnet_id ORDER BY flush_no, part, step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
medians AS (
  SELECT *, list_aggregate(frame, 'median') AS med,
    list_aggregate(list_transform(frame, lambda v: abs(v - list_aggregate(frame, 'median'))), 'median') AS mad FROM framed
),
scored AS (
  SELECT *,
    CASE WHEN c < 10 THEN NULL WHEN c * s2 = s1 * s1 THEN 0.0 ELSE abs(n - s1 / c) / sqrt(s2 / c - (s1 / c) * (s1 / c)) END AS z,
    CASE WHEN c < 10 THEN NULL WHEN mad > 0 THEN abs(n - med) / mad ELSE 0.0 END AS m
  FROM medians
)"""


def verdicts(score: str = "z", score_threshold: float = 0.5, anomaly_threshold: float = 0.1) -> str:
    return f"""
verdicts AS (
  SELECT batch_id, count(*) AS n_steps, count(*) FILTER (WHERE coalesce({score}, 0) >= {score_threshold}) AS n_anomalies,
    count(*) FILTER (WHERE coalesce({score}, 0) >= {score_threshold}) / count(*) > {anomaly_threshold} AS is_suspicious
  FROM scored GROUP BY batch_id
),
suspicious AS (
  SELECT m.*, sha256(m.batch_id || '|' || m.src_ip) AS suspicious_batch_id
  FROM messages m JOIN verdicts v ON m.batch_id = v.batch_id WHERE v.is_suspicious
)"""


# Trailing windows per second-level label, and the Jaro family over their pairs.
TUNNEL = r"""
tunnel AS (
  SELECT *, row_number() OVER w AS arrival, list(thirdleveldomain) OVER f AS subs, list(CAST(logline_id AS VARCHAR)) OVER f AS ids,
    list(domain_name) OVER f AS window_names
  FROM split_names
  WINDOW w AS (PARTITION BY secondleveldomain ORDER BY ts, logline_id),
    f AS (PARTITION BY secondleveldomain ORDER BY ts, logline_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
windows AS (SELECT * FROM tunnel WHERE len(subs) >= 3),
places AS (SELECT i, j FROM range(1, 11) x(i), range(1, 11) y(j) WHERE i < j),
window_pairs AS (SELECT w.logline_id, w.subs[p.i] AS a, w.subs[p.j] AS b FROM windows w JOIN places p ON p.j <= len(w.subs)),
pair_jaro AS (
  SELECT *,
    CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE jaro_similarity(a, b) END AS j,
    CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE jaro_similarity(reverse(a), reverse(b)) END AS r,
    CASE WHEN least(length(a), length(b)) >= 4 AND left(a, 4) = left(b, 4) THEN 4
         WHEN least(length(a), length(b)) >= 3 AND left(a, 3) = left(b, 3) THEN 3
         WHEN least(length(a), length(b)) >= 2 AND left(a, 2) = left(b, 2) THEN 2
         WHEN least(length(a), length(b)) >= 1 AND left(a, 1) = left(b, 1) THEN 1 ELSE 0 END AS head,
    CASE WHEN least(length(a), length(b)) >= 4 AND right(a, 4) = right(b, 4) THEN 4
         WHEN least(length(a), length(b)) >= 3 AND right(a, 3) = right(b, 3) THEN 3
         WHEN least(length(a), length(b)) >= 2 AND right(a, 2) = right(b, 2) THEN 2
         WHEN least(length(a), length(b)) >= 1 AND right(a, 1) = right(b, 1) THEN 1 ELSE 0 END AS tail
  FROM window_pairs
),
window_jaro AS (
  SELECT logline_id, avg(j) AS jaro, avg(r) AS jaro_reversed,
    avg(CASE WHEN j > 0.7 THEN j + head * 0.2 * (1 - j) ELSE j END) AS jaro_winkler,
    avg(CASE WHEN r > 0.7 THEN r + tail * 0.2 * (1 - r) ELSE r END) AS jaro_winkler_reversed
  FROM pair_jaro GROUP BY logline_id
),
window_scores AS (SELECT w.*, j.* EXCLUDE (logline_id) FROM windows w JOIN window_jaro j ON w.logline_id = j.logline_id)"""


# Common subsequences (one bit per letter) and substrings of the same pairs.
COMMON = r"""
text_pairs AS (SELECT DISTINCT a, b FROM window_pairs),
pair_masks AS (
  SELECT a, b, (1::HUGEINT << length(a)) - 1 AS ones, list_transform(string_split(b, ''), lambda c:
    list_sum(list_transform(range(length(a)), lambda i: CASE WHEN substr(a, i + 1, 1) = c THEN 1::HUGEINT << i ELSE 0::HUGEINT END))::HUGEINT) AS masks
  FROM text_pairs WHERE a <> '' AND b <> ''
),
pair_common AS (
  SELECT a, b,
    length(a) - bit_count(list_reduce([ones] || masks, lambda r, m: ((r + (r & m)) | (r - (r & m))) & ones)) AS sequence_length,
    list_max(list_transform(range(1, length(a) + 1), lambda i:
      list_max(list_transform(range(0, length(a) - i + 2), lambda l: CASE WHEN contains(b, substr(a, i, l)) THEN l ELSE 0 END)))) AS string_length
  FROM pair_masks
),
pair_ratios AS (
  SELECT p.logline_id, CASE WHEN p.a = '' AND p.b = '' THEN 1.0 ELSE coalesce(2.0 * c.sequence_length / (length(p.a) + length(p.b)), 0.0) END AS indel,
    coalesce(2.0 * c.sequence_length / (length(p.a) + length(p.b)), 0.0) AS seq, coalesce(2.0 * c.string_length / (length(p.a) + length(p.b)), 0.0) AS run
  FROM window_pairs p LEFT JOIN pair_common c ON p.a = c.a AND p.b = c.b
),
window_common AS (SELECT logline_id, avg(indel) AS levenshtein, avg(seq) AS lcs_sequence, avg(run) AS lcs_string FROM pair_ratios GROUP BY logline_id)"""
