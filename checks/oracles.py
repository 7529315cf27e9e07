"""The same results as plain SQL over the given tables, for DuckDB."""

import re

from checks import queries as q
from checks.tables import CUT_SOURCE, VIEWS, references
from repopulse.functions import text as tx
from repopulse.functions.stopwords import ENGLISH
from repopulse.schemas import COUNT_METRICS, MEAN_METRICS, METRICS, SCORED_METRICS

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
_UNITS = "|".join(rf"\d*{unit}" for unit in tx.UNIT_WORDS) + r"|v\d+"
_WS = r"[ \t\n\x0B\f\r]+"
_NON_ASCII = r"[^\x00-\x7F]"


def _ts(value) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


def _blank_out(text: str) -> str:
    for part in tx.URL_PARTS:
        text = f"replace({text}, '{part}', ' ')"
    return text


def _clean(max_tokens: int | None) -> str:
    text = f"trim(regexp_replace(coalesce(title, '') || ' ' || coalesce(content, ''), '{_WS}', ' ', 'g'))"
    if max_tokens:
        text = f"array_to_string(string_split({text}, ' ')[1:{max_tokens}], ' ')"
    text = _blank_out(f"lower({text})")
    for edge in ("^-", "^_", "-$", "_$"):
        text = f"regexp_replace({text}, '{edge}', '')"
    text = f"trim(regexp_replace(replace({text}, '-', ' '), '{_NON_ASCII}', '', 'g'))"
    return f"CASE WHEN length({text}) >= 2 THEN {text} ELSE '' END"


def _clean_units() -> str:
    text = f"lower(regexp_replace(coalesce(title, '') || ' ' || coalesce(content, ''), '{_NON_ASCII}', '', 'g'))"
    text = _blank_out(text)
    for pattern, by in ((_UNITS, ""), (r"^-+|-+$|_+$|\++", ""),
                        (r"[?!:;<>()\[\]{}*~`%$^&@#=_|''\"]|\\\\", " "), (r"\b\d+\b", " ")):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"regexp_replace(replace({text}, '-', ' '), ' +', ' ', 'g')"


def _seconds(end: str, start: str) -> str:
    return f"(epoch({end}) - epoch({start}))"


def _units(end: str, start: str, size: int) -> str:
    s = f"{_seconds(end, start)} / {size}.0"
    return f"CAST(CASE WHEN {s} > 0 THEN ceil({s}) ELSE floor({s}) END AS BIGINT)"


def _cohort(ts: str) -> str:
    return (f"CASE WHEN year({ts}) BETWEEN {q.BASE_YEAR} AND {q.BASE_YEAR + q.YEARS - 1} THEN "
            f"CAST(CAST((year({ts}) - {q.BASE_YEAR}) * 3 + ceil(month({ts}) / 4.0) AS BIGINT) AS VARCHAR) END")


def _months_between(a: str, b: str) -> str:
    lo, hi = f"least({a}, {b})", f"greatest({a}, {b})"

    def tod(x):
        return f"(hour({x}) * 3600 + minute({x}) * 60 + second({x}))"

    return (f"CAST((year({hi}) * 12 + month({hi})) - (year({lo}) * 12 + month({lo})) - CASE WHEN day({lo}) > day({hi}) "
            f"OR (day({lo}) = day({hi}) AND {tod(lo)} > {tod(hi)}) THEN 1 ELSE 0 END AS BIGINT)")


def _count(metric: str) -> str:
    from repopulse.operators.metrics import EVENT_OF_METRIC
    event, action = EVENT_OF_METRIC[metric]
    extra = f" AND event_action = '{action}'" if action else ""
    return f"CAST(sum(CASE WHEN event = '{event}'{extra} THEN 1 ELSE 0 END) AS BIGINT) AS {metric}"


def _mean(metric: str, event: str) -> str:
    return (f"avg(CASE WHEN event = '{event}' AND response_time > 0 AND event_action = 'closed' "
            f"THEN response_time END) AS {metric}")


def _r(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _sums(prefix: str = "") -> str:
    return ", ".join(f"CAST(sum({prefix}{c}) AS BIGINT) AS {c}" for c in COUNT_METRICS) + ", " + \
        ", ".join(f"avg({prefix}{c}) AS {c}" for c in MEAN_METRICS) + \
        f", CAST(sum({prefix}contributors) AS BIGINT) AS contributors"


_UNTRACKED = ("'DeleteEvent','DeploymentEvent','DeploymentStatusEvent','FollowEvent','ForkApplyEvent',"
              "'GollumEvent','MemberEvent','MembershipEvent','PageBuildEvent','StatusEvent','TeamAddEvent'")
_INT_METRICS = COUNT_METRICS + ["contributors"]
_RMETRICS = ", ".join(COUNT_METRICS) + ", " + _r(MEAN_METRICS) + ", contributors"
_POSITIONS = ("SELECT repo_owner, repo_name, user_type, CAST(repo_created_at AS VARCHAR) AS repo_created_at, "
              "CAST(max_month AS BIGINT) AS max_month, pos, round(value, 6) AS value FROM vectors")

CTES = {name: text.replace("$TS", "TIMESTAMP") for name, text in VIEWS.items()}
CTES["f_forest"] = CTES["f_forest"].replace("explode(sequence(0, 539))", "unnest(range(540))")
CTES["f_lexicon"] = """
SELECT DISTINCT term FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS term FROM @benchmark) t
WHERE length(term) >= 3"""
CTES |= {
    "parsed": f"""
SELECT *, try_cast(CASE WHEN regexp_matches(created, '^\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d\\.000000$') THEN created END AS TIMESTAMP) AS created_at,
       CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS body
FROM @f_archive""",
    "classified": f"""
SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN type IN ({_UNTRACKED}) THEN 'skipped'
               WHEN type = 'PublicEvent' OR (type = 'CreateEvent' AND (body->>'ref_type') = 'repository') THEN 'new_repo'
               WHEN type = 'CreateEvent' OR (type IN ('PullRequestEvent', 'IssuesEvent') AND action IS NULL) THEN 'skipped'
               ELSE 'timeline' END AS outcome
FROM (SELECT *, CASE WHEN (body->>'action') IN ('opened', 'reopened') THEN 'opened' WHEN (body->>'action') = 'closed' THEN 'closed' END AS action,
        CASE WHEN len(string_split(repo_name, '/')) <> 2 THEN 'bad_repo_name'
             WHEN trim(type) = '' OR trim(coalesce(created, '')) = '' THEN 'blank_field'
             WHEN type IN ({_UNTRACKED}) THEN NULL
             WHEN created_at IS NULL THEN 'bad_time'
             WHEN body IS NULL THEN 'bad_json'
             WHEN (type = 'CreateEvent' AND (body->>'ref_type') IS NULL)
               OR (type = 'PullRequestEvent' AND ((body->>'number') IS NULL OR (body->'pull_request') IS NULL))
               OR (type = 'IssuesEvent' AND (body->'issue'->>'number') IS NULL)
               OR (type = 'CommitCommentEvent' AND (body->'comment') IS NULL) THEN 'missing_field' END AS reason
      FROM @parsed) x""",
    "timeline_rows": """
SELECT string_split(repo_name, '/')[1] AS repository_owner, string_split(repo_name, '/')[2] AS repository_name,
       actor_login, created_at, type AS event,
       CASE WHEN type IN ('PullRequestEvent', 'IssuesEvent') THEN action ELSE '' END AS event_action,
       coalesce(CASE type WHEN 'PullRequestEvent' THEN (body->>'number') WHEN 'IssuesEvent' THEN (body->'issue'->>'number')
            WHEN 'CommitCommentEvent' THEN (body->'comment'->>'commit_id') END, '') AS event_number,
       CAST(replace(replace(coalesce((body->'pull_request'->>'created_at'), (body->'issue'->>'created_at')), 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_created_at,
       CASE WHEN action = 'closed' THEN CAST(replace(replace(coalesce((body->'pull_request'->>'closed_at'), (body->'issue'->>'closed_at')), 'T', ' '), 'Z', '') AS TIMESTAMP) END AS event_closed_at,
       CASE WHEN org_id IS NULL AND org_login IS NULL THEN 'User' ELSE 'Organization' END AS user_type
FROM @classified WHERE outcome = 'timeline'""",
    "new_repo_rows": """
SELECT string_split(repo_name, '/')[1] AS repository_owner, string_split(repo_name, '/')[2] AS repository_name,
       created_at AS repo_created_at,
       CASE WHEN org_id IS NULL AND org_login IS NULL THEN 'User' ELSE 'Organization' END AS user_type
FROM @classified WHERE outcome = 'new_repo'""",
    "joined": f"""
SELECT t.repository_owner AS repo_owner, t.repository_name AS repo_name, {_cohort('r.repo_created_at')} AS repo_index,
       {_units('t.created_at', 'r.repo_created_at', 2592000)} AS month, t.actor_login, t.created_at, t.event, t.event_action,
       t.event_number, t.event_created_at, t.event_closed_at,
       {_units('t.event_closed_at', 't.event_created_at', 3600)} AS response_time, r.repo_created_at, r.user_type
FROM @f_timeline t JOIN @f_repo r ON t.repository_owner = r.repository_owner AND t.repository_name = r.repository_name""",
    "monthly": f"""
SELECT repo_owner, repo_name, user_type, month, strftime(created_at, '%Y_%m') AS calendar_month,
       min(repo_index) AS repo_index, min(repo_created_at) AS repo_created_at,
       {', '.join(_count(m) for m in COUNT_METRICS)},
       {_mean('pulls_avg_response_time', 'PullRequestEvent')}, {_mean('issues_avg_response_time', 'IssuesEvent')},
       count(DISTINCT CASE WHEN event IN ('PullRequestEvent', 'IssueCommentEvent', 'PullRequestReviewCommentEvent',
             'IssuesEvent', 'CommitCommentEvent', 'PushEvent') THEN actor_login END) AS contributors
FROM @joined WHERE month > 0 GROUP BY ALL""",
    "active": """
SELECT repo_owner, repo_name, max(month) AS max_month, CAST(sum(watchers) AS BIGINT) AS total_watchers, CAST(sum(forks) AS BIGINT) AS total_forks
FROM @monthly GROUP BY repo_owner, repo_name
HAVING (max(month) > 12 AND sum(watchers) > 50 AND sum(forks) > 50)
    OR (max(month) > 1 AND max(month) <= 12 AND sum(watchers) > 10 AND sum(forks) > 10)
    OR (max(month) = 1 AND sum(watchers) > 5 AND sum(forks) > 5)""",
    "project_months": f"""
SELECT m.repo_owner, m.repo_name, m.user_type, m.month, min(m.repo_index) AS repo_index, max(m.repo_created_at) AS repo_created_at, {_sums('m.')}
FROM @monthly m JOIN @active a ON m.repo_owner = a.repo_owner AND m.repo_name = a.repo_name
GROUP BY m.repo_owner, m.repo_name, m.user_type, m.month""",
    # The running totals as the self-join they replace.
    "cumulative": f"""
SELECT d1.repo_owner, d1.repo_name, d1.user_type, d1.month, min(d2.repo_index) AS repo_index, max(d2.repo_created_at) AS repo_created_at, {_sums('d2.')}
FROM @project_months d1 JOIN @project_months d2 ON d1.repo_owner = d2.repo_owner AND d1.repo_name = d2.repo_name
  AND d1.user_type = d2.user_type AND d1.month >= d2.month
GROUP BY d1.repo_owner, d1.repo_name, d1.user_type, d1.month""",
    "filled": f"""
SELECT repo_owner, repo_name, user_type, month, coalesce(repo_index, '0') AS repo_index, repo_created_at,
       {', '.join(f"coalesce(last_value({m} IGNORE NULLS) OVER w, 0) AS {m}" for m in METRICS)}
FROM @cumulative WINDOW w AS (PARTITION BY repo_owner, repo_name ORDER BY month ROWS UNBOUNDED PRECEDING)""",
    "p95": f"""
SELECT user_type, month, repo_index, {', '.join(f"quantile_cont(CAST({m} AS DOUBLE), 0.95) AS {m}_p" for m in METRICS)}
FROM @filled GROUP BY user_type, month, repo_index""",
    "normalized": f"""
SELECT f.repo_owner, f.repo_name, f.user_type, f.month, f.repo_index, f.repo_created_at,
       {', '.join(f"CASE WHEN p.{m}_p = 0 THEN CAST(f.{m} AS DOUBLE) WHEN f.{m} > p.{m}_p THEN 1.0 ELSE f.{m} / p.{m}_p END AS {m}" for m in METRICS)}
FROM @filled f JOIN @p95 p ON f.user_type = p.user_type AND f.month = p.month AND f.repo_index = p.repo_index""",
    "vector_spine": f"""
SELECT s.repo_owner, s.repo_name, s.user_type, s.month, s.max_month, s.repo_created_at,
       {', '.join(f"coalesce(last_value(n.{m} IGNORE NULLS) OVER w, 0) AS {m}" for m in SCORED_METRICS)}
FROM (SELECT repo_owner, repo_name, user_type, max(month) AS max_month, max(repo_created_at) AS repo_created_at,
             unnest(range(1, max(month) + 1)) AS month
      FROM @normalized WHERE month <= 18 GROUP BY repo_owner, repo_name, user_type) s
LEFT JOIN @normalized n ON s.repo_owner = n.repo_owner AND s.repo_name = n.repo_name AND s.user_type = n.user_type AND s.month = n.month
WINDOW w AS (PARTITION BY s.repo_owner, s.repo_name, s.user_type ORDER BY s.month ROWS UNBOUNDED PRECEDING)""",
    "vectors": f"""
SELECT repo_owner, repo_name, user_type, repo_created_at, max_month, (month - 1) * {len(SCORED_METRICS)} + k AS pos,
       [{', '.join(SCORED_METRICS)}][k + 1] AS value
FROM @vector_spine, range({len(SCORED_METRICS)}) r(k)""",
    "walk0": """
SELECT DISTINCT v.repo_owner, v.repo_name, v.user_type, v.repo_created_at, v.max_month, n.tree, 0 AS node
FROM @vectors v LEFT JOIN @f_forest n ON n.user_type = v.user_type AND n.month = v.max_month""",
    "info": """
SELECT repository_owner, repository_name, full_name, owner_type, lower(coalesce(description, '')) AS description, created_at, watchers_count, doc_id
FROM @f_repository_info
QUALIFY row_number() OVER (PARTITION BY repository_owner, repository_name ORDER BY doc_id) = 1""",
    "metric_files": """
SELECT *, 2001 AS file_year FROM @cumulative
UNION ALL SELECT * REPLACE (watchers - 1 AS watchers), 2000 AS file_year FROM @cumulative""",
    "metric_rows": """
SELECT * FROM @metric_files QUALIFY row_number() OVER (PARTITION BY repo_owner, repo_name, month ORDER BY file_year DESC) = 1""",
    "details": f"""
SELECT * FROM @metric_rows WHERE month <= {_months_between('repo_created_at', _ts(q.DETAILS_AS_OF))} + 1""",
    "stored_posts": f"""
SELECT doc_id, source, date_published,
       replace(translate(regexp_replace(title, '{_NON_ASCII}', '', 'g'), chr(10) || '''', ''), ',', ' ') AS title,
       replace(translate(regexp_replace(content, '{_NON_ASCII}', '', 'g'), chr(10) || '''', ''), ',', ' ') AS content,
       replace(link, ',', 'COMMA') AS link
FROM @f_posts""",
    "cleaned": f"SELECT doc_id, source, {_clean(None)} AS text FROM @f_posts",
    "cleaned_leading": f"SELECT doc_id, source, {_clean(tx.LEADING_TOKENS)} AS text FROM @f_posts",
    "cleaned_units": f"SELECT doc_id, source, {_clean_units()} AS text FROM @f_posts",
    "n_docs": "SELECT source, count(*) AS n FROM @f_posts GROUP BY source",
}


def _text_chain(suffix: str, text: str, split: str) -> dict[str, str]:
    """Token counts, scores and top words on top of one cleaned text."""
    tf, df, sc, top, kept = (f"{n}{suffix}" for n in ("tf", "df", "scored", "top", "kept"))
    return {
        tf: f"""
SELECT source, doc_id, term, count(*) AS tf FROM (SELECT source, doc_id, unnest({split}) AS term FROM @{text}) t
WHERE length(term) > 1 AND term NOT IN ({_STOP}) GROUP BY source, doc_id, term""",
        df: f"SELECT source, term, count(*) AS df FROM @{tf} GROUP BY source, term",
        sc: f"""
SELECT source, doc_id, term, tf, plain, weight, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS tfidf
FROM (SELECT t.source, t.doc_id, t.term, t.tf, t.tf * ln((n + 1) / CAST(df + 1 AS DOUBLE)) AS plain,
             t.tf * (ln((n + 1) / CAST(df + 1 AS DOUBLE)) + 1) AS weight
      FROM @{tf} t JOIN @{df} d ON t.source = d.source AND t.term = d.term JOIN @n_docs n ON n.source = t.source) x""",
        top: f"""
SELECT * FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY weight DESC) AS rank FROM @{sc} WHERE weight > 0) x WHERE rank <= 10""",
        kept: f"""
SELECT source, doc_id, term FROM @{top}
WHERE term IN (SELECT term FROM @f_lexicon) AND NOT contains(term, 'ing') AND NOT contains(term, 'ity')""",
        f"keywords{suffix}": f"""
SELECT p.source, p.doc_id, p.date_published, p.title, p.link, coalesce(string_agg(k.term, ' ' ORDER BY k.term), '') AS top_words
FROM @f_posts p LEFT JOIN @{kept} k ON p.doc_id = k.doc_id GROUP BY ALL""",
    }


CTES |= _text_chain("", "cleaned", "regexp_split_to_array(text, '[^a-z0-9_]+')")
CTES |= _text_chain("_leading", "cleaned_leading", "regexp_split_to_array(text, '[^a-z0-9_]+')")
CTES |= _text_chain("_units", "cleaned_units", "string_split(text, ' ')")
CTES |= {
    "post_words": """
SELECT p.source, p.doc_id, p.date_published, p.title, p.link, k.term AS top_words
FROM @f_posts p JOIN @kept k ON p.doc_id = k.doc_id WHERE p.date_published IS NOT NULL""",
    "ranked_words": f"""
SELECT *, rank() OVER (PARTITION BY source, top_words ORDER BY date_published) AS rank_first_seen,
       round(1.0 / nullif(floor({_seconds(_ts(q.AS_OF), 'date_published')} / 86400.0), 0), 6) AS score
FROM @post_words""",
    "floored_words": f"""
SELECT * FROM @post_words WHERE source <> 'dzone' OR date_published >= TIMESTAMP '{q.FLOORS["dzone"]} 00:00:00'""",
    "cooc": """
SELECT d.source, d.top_words, CAST(d.date_published AS VARCHAR) AS date_published, p.search_results, p.frequency
FROM (SELECT DISTINCT source, top_words, date_published FROM @floored_words) d
JOIN (SELECT a.source, a.top_words, b.top_words AS search_results, count(*) AS frequency
      FROM @floored_words a JOIN @floored_words b ON a.doc_id = b.doc_id AND a.top_words <> b.top_words GROUP BY ALL) p
ON d.source = p.source AND d.top_words = p.top_words""",
    "search_keys": f"""
SELECT *, lower(regexp_replace(split_part(full_name, '/', 2), '{_NON_ASCII}', '', 'g')) AS key FROM @info""",
    "mention": f"""
SELECT k.key, d.doc_id FROM (SELECT DISTINCT key FROM @search_keys WHERE length(key) > 2 AND key NOT IN ({_STOP})) k
JOIN @info d ON contains(d.description, k.key)""",
    "links": """
SELECT DISTINCT a.full_name AS repo1, b.full_name AS repo2, a.author_login AS contributor
FROM @f_contributors a JOIN @f_contributors b ON a.author_login = b.author_login AND a.full_name <> b.full_name""",
}


def oracle(body: str) -> str:
    """``body`` with every CTE it needs in front, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in references(text):
            if name in CTES and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(body)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in order]
    sql = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
    return re.sub(r"@(\w+)", r"\1", sql)


_s = "CAST({0} AS VARCHAR) AS {0}".format
_TIMELINE_OUT = (f"repository_owner, repository_name, actor_login, {_s('created_at')}, event, event_action, event_number, "
                 f"{_s('event_created_at')}, {_s('event_closed_at')}")
_METRIC_HEAD = f"repo_owner, repo_name, user_type, month, repo_index, {_s('repo_created_at')}"
_FIRST = f"""date_trunc('month', {_ts(q.PRUNE_AS_OF)}) - INTERVAL '{25 * q.PRUNE_MONTHS}' DAY"""

# Entities of the given pages; the ampersand last, so that nothing is decoded twice.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "\u00a9", "&middot;": "\u00b7", "&amp;": "&"}


def _page_text() -> str:
    text = "html"
    for pattern in (tx.HIDDEN_BLOCKS, tx.TAGS):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    for entity, char in _ENTITIES.items():
        quoted = char.replace("'", "''")
        text = f"replace({text}, '{entity}', '{quoted}')"
    return (f"SELECT page_id, url, replace(translate(regexp_replace({text}, '{_NON_ASCII}', '', 'g'), "
            f"chr(10) || '''', ''), ',', ' ') AS text FROM pages")


_PAGE_TEXT = _page_text()
# The checksum of a term, byte by byte and bit by bit.
CTES["term_buckets"] = """
SELECT term, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(0, length(h) // 2),
         lambda i: [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) % 200000 AS bucket
FROM (SELECT DISTINCT term, hex(encode(term)) AS h FROM @tf_units) t"""
CTES["hashed"] = """
SELECT source, doc_id, bucket, sum(tf) AS tf FROM @tf_units JOIN @term_buckets USING (term) GROUP BY source, doc_id, bucket"""
_STEP = """
SELECT w.repo_owner, w.repo_name, w.user_type, w.repo_created_at, w.max_month, w.tree,
       CASE WHEN x.value <= n.threshold THEN n.low ELSE n.high END AS node
FROM {walk} w JOIN @f_forest n ON n.user_type = w.user_type AND n.month = w.max_month AND n.tree = w.tree AND n.node = w.node
LEFT JOIN @vectors x ON x.repo_owner = w.repo_owner AND x.repo_name = w.repo_name AND x.pos = n.feature"""
CTES |= {f"walk{i + 1}": _STEP.replace("{walk}", f"@walk{i}") for i in range(3)}

ORACLES = {
    "scan_csv": """
SELECT repository_owner, repository_name, actor_login, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, event, event_action,
       event_number, strftime(event_created_at, '%Y-%m-%d %H:%M:%S') AS event_created_at,
       coalesce(strftime(event_closed_at, '%Y-%m-%d %H:%M:%S'), '') AS event_closed_at FROM @f_timeline""",
    "month_prune": f"""
SELECT year(created_at) AS year, month(created_at) AS month, count(*) AS rows FROM @f_timeline
WHERE strftime(created_at, '%Y-%m') IN (
  SELECT strftime(m, '%Y-%m') FROM (SELECT unnest(generate_series({_FIRST}, {_ts(q.PRUNE_AS_OF)}, INTERVAL '1' MONTH)) AS m) s)
GROUP BY 1, 2""",
    "scan_union": f"SELECT repository_owner, repository_name, {_s('repo_created_at')}, user_type FROM @f_repo",
    "scan_lines": """
SELECT replace(line, ',', '|') AS fields, len(string_split(line, ',')) AS n_fields
FROM (SELECT concat_ws(',', strftime(date_published, '%Y-%m-%d %H:%M:%S'), title, content, link) AS line FROM @stored_posts) x
WHERE NOT contains(line, 'Sponsored Post:')""",
    "time_slices": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) // 3 AS BIGINT) AS slice, count(*) AS rows FROM events GROUP BY 1, 2""",
    "incremental_days": f"""
SELECT CAST(day AS VARCHAR) AS day, count(*) AS rows, CAST(max(max(day)) OVER () AS VARCHAR) AS new_mark
FROM (SELECT CAST(ts AS DATE) AS day FROM events) x WHERE day > DATE '{q.LAST_RUN}' AND day < DATE '{q.LOAD_AS_OF}' GROUP BY day""",
    "incremental_feeds": f"""
SELECT p.source, doc_id, CAST(date_published AS VARCHAR) AS date_published,
       CAST(max(date_published) OVER (PARTITION BY p.source) AS VARCHAR) AS latest
FROM @f_posts p JOIN (VALUES {', '.join(f"('{s}', {_ts(m)})" for s, m in q.MARKS)}) m(source, latest)
ON p.source = m.source AND p.date_published > m.latest""",
    "feed_items": f"SELECT {_s('date_published')}, trim(title) AS title, trim(content) AS content, link FROM @f_posts",
    "half_month_buckets": """
SELECT strftime(created_at, '%Y_%b') || '_' || CAST(half AS VARCHAR) AS bucket, year(created_at) AS year, month(created_at) AS month, half, count(*) AS rows
FROM (SELECT created_at, CASE WHEN day(created_at) <= 15 THEN 1 ELSE 2 END AS half FROM @f_timeline) x GROUP BY ALL""",
    "repo_year_buckets": "SELECT year(repo_created_at) AS year, count(*) AS rows FROM @f_repo GROUP BY 1",
    "sink_roundtrip": f"SELECT doc_id, source, {_s('date_published')}, top_words FROM @keywords",
    "drop_header_rows": f"SELECT repository_owner, repository_name, {_s('repo_created_at')}, user_type FROM @f_repo",
    "repo_details": """
SELECT CASE WHEN ok THEN owner_login ELSE '' END AS repository_owner, CASE WHEN ok THEN name ELSE '' END AS repository_name,
       full_name, CASE WHEN ok THEN owner_type ELSE '' END AS owner_type,
       CASE WHEN ok THEN coalesce(translate(description, ',''"', '   '), '') ELSE '' END AS description, created_at,
       CASE WHEN ok THEN coalesce(CAST(size AS VARCHAR), '') ELSE '' END AS size, CASE WHEN ok THEN coalesce(language, '') ELSE '' END AS language,
       CASE WHEN ok THEN CAST(doc_id AS VARCHAR) ELSE '' END AS watchers_count, CASE WHEN ok THEN '3' ELSE '' END AS forks_count,
       '' AS open_issues_count, CASE WHEN ok THEN 'master' ELSE '' END AS default_branch, score
FROM (SELECT *, state = 'ok' AS ok FROM @f_details) x""",
    "contributor_rows": """
SELECT full_name, coalesce(login, '') AS author_login, coalesce(CAST(total AS VARCHAR), '') AS contributions, '2016-01-01' AS created_at
FROM @f_stats WHERE state = 'ok'
UNION ALL SELECT DISTINCT full_name, '', '', '2016-01-01' FROM @f_stats WHERE state <> 'ok'""",
    "packed_records": "SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "event_whitelist": f"SELECT event_id, type FROM @f_archive WHERE type NOT IN ({_UNTRACKED})",
    "required_fields": """
SELECT event_id, repo_name, type, created FROM @f_archive
WHERE trim(coalesce(repo_name, '')) <> '' AND trim(coalesce(type, '')) <> '' AND trim(coalesce(created, '')) <> ''""",
    "split_repo": """
SELECT event_id, split_part(repo_name, '/', 1) AS repository_owner, split_part(repo_name, '/', 2) AS repository_name
FROM @f_archive WHERE len(string_split(repo_name, '/')) = 2""",
    "canonical_action": """
SELECT event_id, type, event_action FROM (
  SELECT event_id, type, CASE WHEN type NOT IN ('PullRequestEvent', 'IssuesEvent') THEN ''
         WHEN (body->>'action') IN ('opened', 'reopened') THEN 'opened' WHEN (body->>'action') = 'closed' THEN 'closed' END AS event_action
  FROM @parsed) x WHERE event_action IS NOT NULL""",
    "normalize_events": f"SELECT {_TIMELINE_OUT}, user_type FROM @timeline_rows",
    "lake_load": f"SELECT {_TIMELINE_OUT}, user_type FROM @timeline_rows",
    "lake_rejects": "SELECT event_id, reason FROM @classified WHERE outcome = 'rejected'",
    "feed_load": f"""
SELECT p.source, p.doc_id, CAST(p.date_published AS VARCHAR) AS date_published, s.link, md5(s.content || coalesce(g.text, '')) AS content_md5
FROM @f_posts p JOIN @stored_posts s USING (doc_id)
LEFT JOIN (SELECT f.page_id, t.text FROM @f_pages f JOIN ({_PAGE_TEXT}) t USING (page_id) WHERE f.url NOT LIKE 'elsewhere/%') g ON g.page_id = p.doc_id
WHERE p.date_published IS NOT NULL""",
    "file_freshness": "SELECT unnest(['repositories.csv', 'project_recency.csv', 'timeline.csv']) AS file_name, true AS is_new",
    "sql_results": f"""
SELECT {_cohort('r.repo_created_at')} AS repo_index, CAST(c.month AS BIGINT) AS month, count(*) AS repos, CAST(sum(c.watchers) AS BIGINT) AS watchers,
       count(n.repo_name) AS normalized, (SELECT count(*) FROM @f_posts) AS posts
FROM @cumulative c JOIN @f_repo r ON r.repository_owner = c.repo_owner AND r.repository_name = c.repo_name
LEFT JOIN @normalized n ON n.repo_owner = c.repo_owner AND n.repo_name = c.repo_name AND n.month = c.month AND n.user_type = c.user_type
GROUP BY 1, 2""",
    "tfidf_hashed": """
SELECT p.source, p.doc_id, CAST(coalesce(w.n_words, 0) AS BIGINT) AS n_words, CAST(h.bucket AS BIGINT) AS bucket, CAST(h.tf AS BIGINT) AS tf,
       round(h.tf * ln((c.n + 1) / CAST(d.df + 1 AS DOUBLE)), 6) AS tfidf
FROM @f_posts p LEFT JOIN (SELECT source, doc_id, sum(tf) AS n_words FROM @hashed GROUP BY source, doc_id) w ON w.source = p.source AND w.doc_id = p.doc_id
LEFT JOIN @hashed h ON h.source = p.source AND h.doc_id = p.doc_id
LEFT JOIN (SELECT source, bucket, count(*) AS df FROM @hashed GROUP BY source, bucket) d ON d.source = h.source AND d.bucket = h.bucket
JOIN (SELECT source, count(*) AS n FROM @f_posts GROUP BY source) c ON c.source = p.source""",
    "stream_normalize": f"SELECT {_TIMELINE_OUT}, user_type FROM @timeline_rows",
    "new_repos": f"SELECT repository_owner, repository_name, {_s('repo_created_at')}, user_type FROM @new_repo_rows",
    "rejected_events": "SELECT event_id, reason FROM @classified WHERE outcome = 'rejected'",
    "dedupe_repos": f"""
SELECT repository_owner, repository_name, {_s('repo_created_at')}, user_type FROM @new_repo_rows
QUALIFY row_number() OVER (PARTITION BY repository_owner, repository_name ORDER BY new_repo_rows.repo_created_at, user_type) = 1""",
    "timeline_repo": f"""
SELECT repo_owner, repo_name, repo_index, month, actor_login, {_s('created_at')}, event, event_action, event_number,
       {_s('event_created_at')}, {_s('event_closed_at')}, response_time, {_s('repo_created_at')}, user_type FROM @joined""",
    "monthly_metrics": f"SELECT {_METRIC_HEAD}, calendar_month, {_RMETRICS} FROM @monthly",
    "response_times": f"SELECT repo_owner, repo_name, month, calendar_month, {_r(MEAN_METRICS)} FROM @monthly",
    "monthly_contributors": "SELECT repo_owner, repo_name, month, calendar_month, contributors FROM @monthly",
    "active_repos": "SELECT * FROM @active",
    "project_month_metrics": f"SELECT {_METRIC_HEAD}, {_RMETRICS} FROM @project_months",
    "cumulative_metrics": f"SELECT {_METRIC_HEAD}, {_RMETRICS} FROM @cumulative",
    "forward_fill": f"SELECT {_METRIC_HEAD}, {_RMETRICS} FROM @filled",
    "cohort_p95": f"SELECT user_type, month, repo_index, {_r(f'{m}_p' for m in METRICS)} FROM @p95",
    "normalized_metrics": f"SELECT {_METRIC_HEAD}, {_r(METRICS)} FROM @normalized",
    "month_spine": f"""
SELECT s.repo_owner, s.repo_name, s.user_type, s.month,
       {', '.join(f"round(CAST(coalesce(last_value(p.{m} IGNORE NULLS) OVER w, 0) AS DOUBLE), 6) AS {m}" for m in METRICS)}
FROM (SELECT repo_owner, repo_name, user_type, unnest(range(1, max(month) + 1)) AS month FROM @project_months GROUP BY repo_owner, repo_name, user_type) s
LEFT JOIN @project_months p ON s.repo_owner = p.repo_owner AND s.repo_name = p.repo_name AND s.user_type = p.user_type AND s.month = p.month
WINDOW w AS (PARTITION BY s.repo_owner, s.repo_name, s.user_type ORDER BY s.month ROWS UNBOUNDED PRECEDING)""",
    "feature_vectors": _POSITIONS.replace("FROM vectors", "FROM @vectors"),
    "repo_scores_features": _POSITIONS.replace("FROM vectors", "FROM @vectors"),
    "score_repos": """
SELECT round(avg(n.score), 6) AS model_score, r.repo_owner, r.repo_name, r.user_type, CAST(r.repo_created_at AS VARCHAR) AS repo_created_at,
       CAST(r.max_month AS BIGINT) AS age_of_project
FROM (SELECT DISTINCT repo_owner, repo_name, user_type, repo_created_at, max_month FROM @vectors) r
LEFT JOIN @walk3 w ON w.repo_owner = r.repo_owner AND w.repo_name = r.repo_name
LEFT JOIN @f_forest n ON n.user_type = w.user_type AND n.month = w.max_month AND n.tree = w.tree AND n.node = w.node
GROUP BY r.repo_owner, r.repo_name, r.user_type, r.repo_created_at, r.max_month""",
    "score_cutoff": """
SELECT repo_owner || '/' || repo_name AS full_name, strftime(repo_created_at, '%Y-%m-%d') AS created_at, round(model_score, 6) AS score
FROM @f_scores WHERE model_score >= 0.14""",
    "date_diff_units": f"""
SELECT l_orderkey, l_linenumber, {_units('l_shipdate', 'o_orderdate', 2592000)} AS months, {_units('o_orderdate', 'l_shipdate', 3600)} AS hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cohort_index": f"SELECT o_orderkey, {_cohort('o_orderdate')} AS repo_index FROM orders",
    "whole_months": f"""
SELECT event_id, {_months_between("s", "TIMESTAMP '1997-06-15 12:00:00'")} AS months
FROM (SELECT event_id, ts - INTERVAL '26' YEAR AS s FROM events) x""",
    "sql_functions": f"""
SELECT l_orderkey, l_linenumber, {_units('l_shipdate', 'o_orderdate', 2592000)} AS months,
       {_units('l_shipdate', 'o_orderdate', 3600)} AS hours, {_cohort('o_orderdate')} AS repo_index
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "consolidated_info": "SELECT * FROM @info",
    "age_split": f"""
SELECT doc_id, created_at, coalesce(created_at > '2015-01-01', FALSE) AS is_young FROM @f_repository_info""",
    "project_recency": "SELECT owner_type, full_name, watchers_count, created_at FROM @f_repository_info WHERE owner_type IS NOT NULL",
    "dedupe_metrics": f"SELECT {_METRIC_HEAD}, {_RMETRICS}, file_year FROM @metric_rows",
    "plausible_months": f"""
SELECT repo_owner, repo_name, month FROM @cumulative WHERE month <= {_months_between('repo_created_at', _ts(q.DETAILS_AS_OF))} + 1""",
    "project_details": f"SELECT {_METRIC_HEAD}, {_RMETRICS}, file_year FROM @details",
    "sorted_details": f"SELECT {_METRIC_HEAD}, {_RMETRICS}, file_year FROM @details ORDER BY repo_owner, repo_name, month",
    "union_sources": """
SELECT source, doc_id, title FROM @f_posts UNION ALL SELECT repository_owner, doc_id, full_name FROM @f_repository_info""",
    "clean_text": "SELECT doc_id, text FROM @cleaned",
    "clean_text_leading": "SELECT doc_id, text FROM @cleaned_leading",
    "clean_text_units": "SELECT doc_id, text FROM @cleaned_units",
    "leading_tokens": f"""
SELECT doc_id, array_to_string(string_split(trim(regexp_replace(text, '{_WS}', ' ', 'g')), ' ')[1:100], ' ') AS text FROM documents""",
    "ascii_only": f"SELECT doc_id, regexp_replace(text, '{_NON_ASCII}', '', 'g') AS text FROM documents",
    "clean_feed_fields": f"""
SELECT s.doc_id, s.source, CAST(s.date_published AS VARCHAR) AS date_published, s.title, s.link,
       CASE WHEN s.source = '{CUT_SOURCE}' THEN replace(regexp_replace(translate(regexp_replace(p.content, '{_NON_ASCII}', '', 'g'), chr(10) || '''', ''), 'The .*? the ', '', 'g'), ',', ' ')
            ELSE s.content END AS content
FROM @stored_posts s JOIN @f_posts p ON s.doc_id = p.doc_id""",
    "source_from_file": "SELECT doc_id, link, source, CAST(1 AS BIGINT) AS no_of_links FROM @f_posts",
    "stopword_set": """
SELECT DISTINCT word FROM (SELECT unnest(string_split(replace(replace(replace(replace(replace(replace(line, chr(39), ''), '[', ''), ']', ''), chr(9), ' '), '/', ' '), '.', ' '), ' ')) AS word FROM @f_stop_lines) x
WHERE word <> ''""",
    "tokens": "SELECT * FROM @tf",
    "tokens_units": "SELECT * FROM @tf_units",
    "tfidf": "SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM @scored",
    "tfidf_plain": "SELECT doc_id, term, tf, round(plain, 6) AS tfidf FROM @scored_units",
    "top_terms": "SELECT doc_id, term, rank, round(tfidf, 6) AS tfidf FROM @top",
    "top_terms_strict": """
SELECT doc_id, term, rank, round(plain, 6) AS tfidf FROM (
  SELECT doc_id, term, plain, row_number() OVER (PARTITION BY doc_id ORDER BY plain DESC, term) AS rank FROM @scored_units) x WHERE rank <= 10""",
    "lexicon_filter": "SELECT doc_id, term FROM @top WHERE term IN (SELECT term FROM @f_lexicon)",
    "top_terms_clean": "SELECT doc_id, term FROM @kept",
    "post_keywords": f"SELECT source, doc_id, {_s('date_published')}, title, link, top_words FROM @keywords",
    "post_keywords_leading": f"SELECT source, doc_id, {_s('date_published')}, title, link, top_words FROM @keywords_leading",
    "post_keywords_strict": f"""
SELECT p.source, p.doc_id, {_s('date_published')}, p.title, p.link, coalesce(string_agg(k.term, ' ' ORDER BY k.term), '') AS top_words
FROM @f_posts p LEFT JOIN (
  SELECT doc_id, term FROM (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY plain DESC, term) AS rank FROM @scored_units) x
  WHERE rank <= 10 AND term IN (SELECT term FROM @f_lexicon)) k ON p.doc_id = k.doc_id GROUP BY ALL""",
    "word_pairs": "SELECT a.doc_id, a.term AS word, b.term AS other FROM @kept a JOIN @kept b ON a.doc_id = b.doc_id AND a.term <> b.term",
    "trailing_scores": """
SELECT source, top_words, CAST(CAST(upper AS DATE) AS VARCHAR) AS benchmark_date,
       round(sum((180 - floor((epoch(upper) - epoch(date_published)) / 86400.0)) / 180), 6) AS score, count(*) AS no_of_links
FROM @post_words JOIN (SELECT TIMESTAMP '2016-06-04 00:00:00' - i * INTERVAL '1' DAY AS upper,
                              TIMESTAMP '2015-12-04 00:00:00' - i * INTERVAL '1' DAY AS lower FROM range(30) r(i)) b
  ON date_published > lower AND date_published <= upper
GROUP BY source, top_words, upper""",
    "first_seen": f"SELECT source, doc_id, {_s('date_published')}, title, link, top_words, rank_first_seen, score FROM @ranked_words",
    "cooccurrence": "SELECT * FROM @cooc",
    "cooccurrence_ranked": "SELECT *, count(*) OVER (PARTITION BY source, top_words) AS word_rows FROM @cooc",
    "recency_frequency": """
SELECT source, top_words, CAST(max(date_published) AS VARCHAR) AS date_published, count(*) AS frequency FROM @post_words GROUP BY source, top_words""",
    "name_mentions": "SELECT key, doc_id FROM @mention",
    "mention_counts": """
SELECT full_name, coalesce(n, 0) AS other_repo_count FROM @search_keys k
LEFT JOIN (SELECT key, count(*) AS n FROM @mention GROUP BY key) m ON m.key = k.key""",
    "mention_graph": """
SELECT e.repo1, e.repository_name, e.created_at, e.frequency, i.full_name AS repo2
FROM (SELECT k.full_name AS repo1, d.repository_name, k.created_at, count(*) AS frequency
      FROM @mention m JOIN @search_keys k ON m.key = k.key JOIN @info d ON d.doc_id = m.doc_id GROUP BY ALL) e
LEFT JOIN @info i ON i.repository_name = e.repository_name
WHERE i.full_name IS NULL OR e.repo1 <> i.full_name""",
    "shared_contributor_pairs": "SELECT * FROM @links",
    "contributor_graph": """
SELECT l.repo1, l.repo2, l.contributors, len(string_split(l.contributors, ',')) AS no_common_contributors, c.created_at
FROM (SELECT repo1, repo2, replace(replace(replace(string_agg(contributor, ',' ORDER BY contributor), '&,', '& '), '-,', '-'), ',,', ',') AS contributors
      FROM @links GROUP BY repo1, repo2) l
LEFT JOIN (SELECT DISTINCT full_name, created_at FROM @f_contributors) c ON c.full_name = l.repo1""",
    "stream_landing": "SELECT concat_ws(',', event_id, user_id, event_type, value) AS value FROM events",
    "stream_rejects": """
SELECT concat_ws(',', event_id, user_id, event_type, value) AS value, CASE WHEN event_type <> 'error' THEN 'valid' ELSE 'reject' END AS lane FROM events""",
}


ORACLES["page_text"] = _PAGE_TEXT
ORACLES["mention_graph_sorted"] = ORACLES["mention_graph"] + " ORDER BY e.created_at DESC, repo1, repository_name, repo2"
ORACLES = {name: oracle(sql) for name, sql in ORACLES.items()}
