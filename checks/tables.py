"""Repository-shaped views over the given tables, one text for Spark and DuckDB.

``@name`` marks a table or another view; ``$TS`` is the zone-less timestamp type of the engine.
Every view covers its whole source table.
"""

import functools
import re

from pyspark.sql import DataFrame, SparkSession

from repopulse.operators import ranking
from repopulse.sources import feeds


VIEWS = {
    "f_repo": """
SELECT 'own' || CAST(s_suppkey % 20 AS STRING) AS repository_owner,
       'repo' || CAST(s_suppkey AS STRING) AS repository_name,
       CAST(make_date(CAST(1995 + floor((s_suppkey % 24) / 12) AS INT), CAST(1 + s_suppkey % 12 AS INT), 1) AS $TS) AS repo_created_at,
       CASE WHEN s_suppkey % 4 = 0 THEN 'Organization' ELSE 'User' END AS user_type
FROM @supplier""",
    "f_timeline": """
SELECT 'own' || CAST(l_suppkey % 20 AS STRING) AS repository_owner,
       'repo' || CAST(l_suppkey AS STRING) AS repository_name,
       'u' || CAST(o_custkey AS STRING) AS actor_login,
       l_shipdate AS created_at,
       CASE (l_orderkey + 3 * l_linenumber) % 11
         WHEN 0 THEN 'WatchEvent' WHEN 1 THEN 'ForkEvent' WHEN 2 THEN 'PullRequestEvent'
         WHEN 3 THEN 'PullRequestReviewCommentEvent' WHEN 4 THEN 'IssuesEvent' WHEN 5 THEN 'IssueCommentEvent'
         WHEN 6 THEN 'CommitCommentEvent' WHEN 7 THEN 'PushEvent' WHEN 8 THEN 'ReleaseEvent'
         WHEN 9 THEN 'DownloadEvent' ELSE 'GistEvent' END AS event,
       CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'opened' ELSE '' END AS event_action,
       CAST(l_orderkey AS STRING) AS event_number,
       o_orderdate AS event_created_at,
       CASE WHEN o_orderstatus = 'F' THEN l_shipdate END AS event_closed_at
FROM @lineitem JOIN @orders ON l_orderkey = o_orderkey""",
    "f_contributors": """
SELECT DISTINCT t.repository_owner || '/' || t.repository_name AS full_name,
       CASE WHEN t.actor_login LIKE '%7' THEN NULL ELSE t.actor_login END AS author_login,
       CAST(CAST(r.repo_created_at AS DATE) AS STRING) AS created_at
FROM @f_timeline t JOIN @f_repo r ON t.repository_owner = r.repository_owner AND t.repository_name = r.repository_name""",
    "f_posts": """
SELECT doc_id,
       CASE doc_id % 3 WHEN 0 THEN '$CUT' WHEN 1 THEN 'plain_blog' ELSE '$FLOOR' END AS source,
       CASE WHEN doc_id % 50 = 49 THEN NULL ELSE $TS '2016-06-05 00:00:00' - (doc_id % 400) * INTERVAL '1' DAY - (doc_id % 7) * INTERVAL '1' HOUR END AS date_published,
       CASE WHEN doc_id % 40 = 0 THEN 'Sponsored Post: ' ELSE '' END || lang || ' ' || source AS title,
       text AS content, 'post/' || CAST(doc_id AS STRING) || CASE WHEN doc_id % 5 = 0 THEN ',1' ELSE '' END AS link
FROM @documents""",
    "f_repository_info": """
SELECT source AS repository_owner, regexp_extract(lower(text), '[a-z]{3,}', 0) AS repository_name,
       source || '/' || regexp_extract(lower(text), '[a-z]{3,}', 0) AS full_name,
       CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN 'Organization' ELSE 'User' END AS owner_type,
       CASE WHEN doc_id % 31 = 30 THEN NULL ELSE text END AS description,
       CASE WHEN doc_id % 33 = 0 THEN NULL ELSE CAST(CAST($TS '2016-06-05 00:00:00' - (doc_id % 900) * INTERVAL '1' DAY AS DATE) AS STRING) END AS created_at,
       n_chars AS watchers_count, doc_id
FROM @documents""",
    "f_archive": """
SELECT event_id,
       CASE WHEN event_id % 73 = 0 THEN ' ' ELSE type END AS type,
       CASE WHEN event_id % 89 = 0 THEN substring(payload, 1, 5) WHEN event_id % 71 = 0 THEN '{}' ELSE payload END AS payload,
       CASE WHEN event_id % 97 = 0 THEN 'noslash' WHEN event_id % 101 = 0 THEN 'a/b/c'
            ELSE 'own' || CAST(user_id % 20 AS STRING) || '/repo' || CAST(user_id AS STRING) END AS repo_name,
       'u' || CAST(event_id % 53 AS STRING) AS actor_login,
       CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN sec WHEN event_id % 67 = 0 THEN 'n/a'
            WHEN event_id % 61 = 0 THEN replace(replace(sec, '-', ''), ':', '') WHEN event_id % 59 = 0 THEN '2024-02-30 03:00:00.000000' ELSE sec || '.000000' END AS created,
       CASE WHEN user_id % 4 = 0 THEN CAST(user_id AS STRING) END AS org_id,
       CASE WHEN user_id % 4 = 0 THEN 'org' || CAST(user_id AS STRING) END AS org_login
FROM (SELECT *, CASE type
         WHEN 'PullRequestEvent' THEN '{"action":"' || act || '","number":' || n || ',"pull_request":{"created_at":"' || iso || '","closed_at":' || closed || '}}'
         WHEN 'IssuesEvent' THEN '{"action":"' || act || '","issue":{"number":' || n || ',"created_at":"' || iso || '","closed_at":' || closed || '}}'
         WHEN 'CommitCommentEvent' THEN '{"comment":{"commit_id":"c' || n || '"}}'
         WHEN 'CreateEvent' THEN '{"ref_type":"' || CASE WHEN act = 'closed' THEN 'branch' ELSE 'repository' END || '"}'
         ELSE '{}' END AS payload
      FROM (SELECT *, CAST(event_id AS STRING) AS n,
                   CASE WHEN act = 'closed' AND event_id % 3 > 0 THEN '"' || iso || '"' ELSE 'null' END AS closed
            FROM (SELECT event_id, user_id, CAST(date_trunc('second', ts) AS STRING) AS sec,
                         replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || 'Z' AS iso,
                         CASE CAST(floor(event_id / 16) AS BIGINT) % 4 WHEN 0 THEN 'opened' WHEN 1 THEN 'reopened' WHEN 2 THEN 'closed' ELSE 'labeled' END AS act,
                         CASE event_id % 16 WHEN 0 THEN 'WatchEvent' WHEN 1 THEN 'ForkEvent' WHEN 2 THEN 'PullRequestEvent'
                           WHEN 3 THEN 'PullRequestReviewCommentEvent' WHEN 4 THEN 'IssuesEvent' WHEN 5 THEN 'IssueCommentEvent'
                           WHEN 6 THEN 'CommitCommentEvent' WHEN 7 THEN 'PushEvent' WHEN 8 THEN 'ReleaseEvent' WHEN 9 THEN 'DownloadEvent'
                           WHEN 10 THEN 'GistEvent' WHEN 11 THEN 'CreateEvent' WHEN 12 THEN 'PublicEvent' WHEN 13 THEN 'DeleteEvent'
                           WHEN 14 THEN 'FollowEvent' ELSE 'GollumEvent' END AS type
                  FROM @events) a) b) c""",
    "f_scores": """
SELECT CAST((s_suppkey * 37) % 100 AS DOUBLE) / 100 AS model_score, 'own' || CAST(s_suppkey % 20 AS STRING) AS repo_owner,
       'repo' || CAST(s_suppkey AS STRING) AS repo_name, r.user_type, r.repo_created_at
FROM @supplier JOIN @f_repo r ON r.repository_name = 'repo' || CAST(s_suppkey AS STRING)""",
    "f_forest": """
SELECT CASE WHEN cohort % 2 = 0 THEN 'User' ELSE 'Organization' END AS user_type, CAST(1 + floor(cohort / 2) AS INT) AS month, tree, node,
       CASE WHEN node < 7 THEN CAST((tree * 31 + cohort * 7 + node * 13) % (11 * (1 + floor(cohort / 2))) AS INT) END AS feature,
       CASE WHEN node < 7 THEN CAST((tree * 17 + cohort * 5 + node * 3) % 40 AS DOUBLE) / 8 + 0.0137 END AS threshold,
       CASE WHEN node < 7 THEN 2 * node + 1 END AS low, CASE WHEN node < 7 THEN 2 * node + 2 END AS high,
       CASE WHEN node >= 7 THEN CAST((tree * 29 + cohort * 11 + node * 19) % 101 AS DOUBLE) / 101 END AS score
FROM (SELECT CAST(n_nationkey AS INT) AS tree, CAST(floor(k / 15) AS INT) AS cohort, CAST(k % 15 AS INT) AS node
      FROM (SELECT n_nationkey, explode(sequence(0, 539)) AS k FROM @nation) a) b""",
    "f_pages": """
SELECT page_id, CASE WHEN page_id % 9 > 6 THEN 'elsewhere/' WHEN page_id % 3 = 0 THEN 'HTTP://Post/' WHEN page_id % 3 = 1 THEN 'post/' ELSE ' post/' END || CAST(page_id AS STRING)
       || CASE WHEN page_id % 5 = 0 THEN ',1' ELSE '' END || CASE page_id % 4 WHEN 0 THEN '/' WHEN 1 THEN '#top' ELSE '' END AS url, html
FROM @pages""",
    "f_stop_lines": """
SELECT replace(p_name, ' ', chr(9)) || '/' || p_brand || '.' || p_type || ' [' || chr(39) || p_name || chr(39) || ']' AS line FROM @part""",
    "f_lexicon": """
SELECT DISTINCT term FROM (SELECT explode(split(lower(text), '[^a-z0-9_]+')) AS term FROM @benchmark) t
WHERE length(term) >= 3""",
    "f_details": """
SELECT doc_id, source || '/' || 'name' || CAST(doc_id AS STRING) AS full_name, lang AS owner_login,
       CASE WHEN doc_id % 4 = 0 THEN 'Organization' ELSE 'User' END AS owner_type,
       CASE WHEN doc_id % 6 = 5 THEN NULL ELSE text END AS description, 'name' || CAST(doc_id AS STRING) AS name,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars END AS size,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS language,
       CASE WHEN doc_id % 17 = 0 THEN 'cut' WHEN doc_id % 19 = 0 THEN 'none' ELSE 'ok' END AS state,
       '2016-01-0' || CAST(1 + doc_id % 9 AS STRING) AS created_at, CAST(doc_id % 100 AS STRING) AS score
FROM @documents""",
    "f_stats": """
SELECT conv_id, turn, 'own/conv' || CAST(conv_id AS STRING) AS full_name,
       CASE WHEN turn % 5 = 4 THEN NULL ELSE role || CAST(turn AS STRING) END AS login,
       CASE WHEN turn % 7 = 6 THEN NULL ELSE length(text) END AS total,
       CASE WHEN conv_id % 11 = 0 THEN 'cut' WHEN conv_id % 13 = 0 THEN 'none' WHEN conv_id % 17 = 0 THEN 'empty' ELSE 'ok' END AS state
FROM @conversations""",
}

# Two source names matter to the operators and are taken from them; all others are invented.
CUT_SOURCE, FLOOR_SOURCE = next(iter(feeds.BOILERPLATE_PATTERNS)), next(iter(ranking.DATE_FLOORS))
VIEWS["f_posts"] = VIEWS["f_posts"].replace("$CUT", CUT_SOURCE).replace("$FLOOR", FLOOR_SOURCE)

_REF = re.compile(r"@(\w+)")


def references(text: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(text)))


class Tables:
    """Given tables and the views over them for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @functools.cache
    def __getitem__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = VIEWS[name]
        inputs = {ref: self[ref] for ref in references(text)}
        template = _REF.sub(r"{\1}", text.replace("{", "{{").replace("}", "}}"))
        return self.spark.sql(template.replace("$TS", "TIMESTAMP_NTZ"), **inputs)
