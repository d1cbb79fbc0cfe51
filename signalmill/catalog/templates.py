"""Templates of log bodies and search by terms."""

from __future__ import annotations

from ..operators import templates as T
from ..session import work_dir
from ..sinks import rewrite_clustered
from ..sources import read_table
from . import adapters as A
from .book import cte, query

# Fewer branches than the bodies' first words, so that the tree has wide nodes.
DEPTH, BRANCHES = 2, 3

cte("masked", r"""SELECT *, list_transform(list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> ''),
       lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS words FROM logs""", ("logs",))  # fmt: skip
cte("level0", f"""SELECT *, CASE WHEN words[1] IS NOT NULL AND (SELECT count(DISTINCT m.words[1]) FROM masked m WHERE len(m.words) = len(k.words)) > {BRANCHES}
       THEN '<*>' ELSE words[1] END AS w1 FROM masked k""", ("masked",))  # fmt: skip
cte("level1", f"""SELECT l.*, CASE WHEN l.words[2] IS NOT NULL AND n > {BRANCHES} THEN '<*>' ELSE l.words[2] END AS w2 FROM level0 l
    LEFT JOIN (SELECT len(words) AS length, w1, count(DISTINCT words[2]) AS n FROM level0 GROUP BY 1, 2) c
      ON c.length = len(l.words) AND c.w1 IS NOT DISTINCT FROM l.w1""", ("level0",))  # fmt: skip
cte("level2", """SELECT l.*, CASE WHEN l.words[3] IS NOT NULL AND n > 1 THEN '<*>' ELSE l.words[3] END AS w3 FROM level1 l
    LEFT JOIN (SELECT len(words) AS length, w1, w2, count(DISTINCT words[3]) AS n FROM level1 GROUP BY 1, 2, 3) c
      ON c.length = len(l.words) AND c.w1 IS NOT DISTINCT FROM l.w1 AND c.w2 IS NOT DISTINCT FROM l.w2""", ("level1",))  # fmt: skip


@query("log_templates", "SELECT concat_ws(' ', w1, w2, w3) AS template, count(*) AS log_count, count(DISTINCT words) AS body_kinds FROM level2 GROUP BY 1", uses=("level2",))
def _(spark, d):
    return T.log_templates(A.logs(spark, d), depth=DEPTH, branches=BRANCHES)


@query("log_template_of", "SELECT trace_id, span_id, observed_timestamp, body, concat_ws(' ', w1, w2, w3) AS template FROM level2", uses=("level2",))
def _(spark, d):
    logs = A.logs(spark, d)
    found = T.with_template(logs, T.template_map(logs, depth=DEPTH, branches=BRANCHES))
    return found.select("trace_id", "span_id", "observed_timestamp", "body", "template")


@query(
    "log_search",
    r"""SELECT trace_id, span_id, observed_timestamp FROM logs
    WHERE list_has_all(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'), ['click', '69'])""",
    uses=("logs",),
)
def _(spark, d):
    keep, path = ["trace_id", "span_id", "observed_timestamp"], work_dir(spark, "postings")
    rewrite_clustered(T.postings(A.logs(spark, d), keep), path, ["term"])
    return T.search(read_table(spark, path), ["click", "69"], keep)


@query(
    "document_search",
    r"""SELECT doc_id FROM documents WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), ['license', 'version'])""",
)
def _(spark, d):
    docs, path = A.table(spark, d, "documents"), work_dir(spark, "document-postings")
    rewrite_clustered(T.postings(docs, ["doc_id"], "text"), path, ["term"])
    return T.search(read_table(spark, path), ["License", "version"], ["doc_id"])
