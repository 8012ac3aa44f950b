"""Article labels."""

from pyspark.sql import functions as F

from ..functions import build_prompt, keyword_category, normalize_category, truncate_text
from ..operators import classify as k
from ..operators import text_model as t
from ..operators.metrics import category_counts
from . import Query, Views

# Rules that fit the given texts.
TERMS = {
    "english": [" the ", " and ", " of "],
    "french": [" le ", " que ", " dans "],
    "german": [" der ", " und ", " nicht "],
    "spanish": [" el ", " los ", " por "],
}


def _hits(terms: list[str]) -> str:
    text = "lower(concat(title, ' ', content))"
    return " + ".join(f"cast(contains({text}, '{t}') AS int)" for t in terms)


_SCORES = ", ".join(f"{_hits(t)} AS n{i}" for i, t in enumerate(TERMS.values()))
_PICK = "CASE WHEN greatest(n0, n1, n2, n3) = 0 THEN 'miscellaneous' " + " ".join(
    f"WHEN n{i} = greatest(n0, n1, n2, n3) THEN '{name}'" for i, name in enumerate(TERMS)
) + " END"
_SCORED = f"scored AS (SELECT url, {_PICK} AS category FROM (SELECT url, {_SCORES} FROM articles))"
_MERGED = """merged AS (SELECT url, category FROM old_labels WHERE category IS NOT NULL
                        UNION ALL SELECT * FROM scored ANTI JOIN
                          (SELECT url FROM old_labels WHERE category IS NOT NULL) USING (url))"""


def _answer(prompt: str) -> str:
    """Stands for an outside classifier: answers, stays silent, or fails."""
    text = prompt.split("Article Content:\n", 1)[1].rsplit("\n\nRespond with", 1)[0]
    if "zukeit" in text:
        raise RuntimeError("no answer")
    return " english\n" if " the " in text else ""


def _labels(v: Views):
    return k.classify_articles(v.articles, v.labels, k.keyword_scorer(TERMS))


def _learned(v: Views):
    """Articles whose language stands for a label: four in five teach, the fifth is labelled."""
    teach, ask = F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 0
    return v.articles.filter(teach).withColumn("category", F.col("language")), v.articles.filter(ask)


def _bayes_scores(v: Views):
    teach, ask = _learned(v)
    classes, weights = t.bayes_model(teach, t.title_and_text())
    found = t.scores(ask, "url", F.transform(t.words(t.title_and_text()), t.slot), classes, weights)
    return found.select("url", F.col("class").alias("category"), F.round("score", 4).alias("log_score"))


def _bayes_labels(v: Views):
    teach, ask = _learned(v)
    none = v.labels.limit(0)
    return k.classify_articles(ask, none, t.bayes_scorer(teach))


_BAYES = rf"""
  terms AS (SELECT doc_id, url, language,
                   list_filter(string_split_regex(lower(concat_ws(' ', title, content)), '[^\p{{L}}]+'), lambda w: w <> '') AS w FROM articles),
  slots AS (SELECT doc_id, url, language, ('0x' || left(md5(unnest(w)), 3))::INT AS slot FROM terms),
  taught AS (SELECT language AS category, count(*) AS texts, sum(len(w)) AS n FROM terms WHERE doc_id % 5 <> 0 GROUP BY language),
  counts AS (SELECT language AS category, slot, count(*) AS n FROM slots WHERE doc_id % 5 <> 0 GROUP BY ALL),
  hits AS (SELECT url, category, sum(ln(n + 1)) AS more FROM slots JOIN counts USING (slot) WHERE doc_id % 5 = 0 GROUP BY ALL),
  bayes AS (SELECT url, category,
                   ln(texts / (SELECT sum(texts) FROM taught)) - len(w) * ln(n + {t.SLOTS}) + coalesce(more, 0) AS score
            FROM terms CROSS JOIN taught LEFT JOIN hits USING (url, category) WHERE doc_id % 5 = 0)"""
_GROUPS = r"""
  spelled AS (SELECT doc_id, url, language, unnest(list_filter(string_split_regex(lower(content), '[^\p{L}]+'), lambda w: w <> '')) AS w FROM articles),
  groups AS (SELECT doc_id, url, language, unnest(list_concat(
               list_transform(range(1, length(w) + 2), lambda i: substr('_' || w || '_', i, 2)),
               list_transform(range(1, length(w) + 1), lambda i: substr('_' || w || '_', i, 3)))) AS token FROM spelled),
  profiles AS (SELECT language, token, row_number() OVER (PARTITION BY language ORDER BY count(*) DESC, token) - 1 AS rank
               FROM groups WHERE doc_id % 5 <> 0 GROUP BY language, token)"""

QUERIES = {
    "bayes_scores": Query(_bayes_scores, f"WITH {_BAYES} SELECT url, category, round(score, 4) AS log_score FROM bayes"),
    "classify_by_bayes": Query(
        _bayes_labels,
        f"""WITH {_BAYES} SELECT url, category FROM bayes
            QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, category) = 1""",
    ),
    "language_profiles": Query(
        lambda v: t.language_profiles(_learned(v)[0]), f"WITH {_GROUPS} SELECT language, token, rank::INT AS rank FROM profiles WHERE rank < {t.PROFILE}"
    ),
    "languages_by_profile": Query(
        lambda v: t.languages_by_profile(_learned(v)[1], t.language_profiles(_learned(v)[0])),
        f"""WITH {_GROUPS},
            near AS (SELECT url, p.language, sum({t.PROFILE} - rank) AS score FROM groups g JOIN profiles p USING (token)
                     WHERE rank < {t.PROFILE} AND doc_id % 5 = 0 GROUP BY ALL),
            first AS (SELECT url, language FROM near QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, language) = 1)
            SELECT url, coalesce(first.language, 'unknown') AS language FROM articles LEFT JOIN first USING (url) WHERE doc_id % 5 = 0""",
    ),
    "keyword_category": Query(
        lambda v: v.articles.select("url", keyword_category("title", "content", TERMS).alias("category")),
        f"WITH {_SCORED} SELECT url, category FROM scored",
    ),
    "unclassified": Query(
        lambda v: k.unclassified(v.articles, v.labels).select("url"),
        "SELECT url FROM articles ANTI JOIN (SELECT url FROM old_labels WHERE category IS NOT NULL) USING (url)",
    ),
    "unclassified_retry": Query(
        lambda v: k.unclassified(v.articles, v.labels, retry_errors=True).select("url"),
        "SELECT url FROM articles ANTI JOIN (SELECT url FROM old_labels WHERE category <> 'error') USING (url)",
    ),
    "classify_articles": Query(_labels, f"WITH {_SCORED}, {_MERGED} SELECT url, category FROM merged"),
    "classify_with_callable": Query(
        lambda v: k.classify_articles(v.articles, v.labels, k.callable_scorer(_answer), retry_errors=True),
        """WITH done AS (SELECT url, category FROM old_labels WHERE category <> 'error')
           SELECT url, category FROM done UNION ALL
           SELECT url, CASE WHEN contains(content, 'zukeit') THEN 'error'
                            WHEN contains(content, ' the ') THEN 'english' ELSE 'unknown' END
           FROM articles ANTI JOIN done USING (url)""",
    ),
    "merge_classifications": Query(
        lambda v: k.merge_classifications(
            v.labels, v.articles.filter("language = 'fr'").select("url", F.lit("international").alias("category"))
        ),
        """SELECT url, category FROM old_labels ANTI JOIN (SELECT url FROM articles WHERE language = 'fr') USING (url)
           UNION ALL SELECT url, 'international' FROM articles WHERE language = 'fr'""",
    ),
    "articles_with_category": Query(
        lambda v: k.articles_with_category(v.articles, v.labels).select("url", "source_domain", "category"),
        "SELECT url, source_domain, category FROM articles LEFT JOIN old_labels USING (url)",
    ),
    "category_counts": Query(
        lambda v: category_counts(k.articles_with_category(v.articles, _labels(v))),
        f"WITH {_SCORED}, {_MERGED} SELECT category, count(url) AS count FROM articles LEFT JOIN merged USING (url) GROUP BY category",
    ),
    "build_prompt": Query(
        lambda v: v.articles.select("url", build_prompt("title", "content", ["health", "border"]).alias("prompt")),
        r"""SELECT url, concat('You are a news article classifier. Classify the following article into exactly ONE of these categories:',
              E'\n\n- health\n- border\n\nArticle Title: ', title, E'\n\nArticle Content:\n',
              content, E'\n\nRespond with ONLY the category name, nothing else.') AS prompt FROM articles""",
    ),
    "build_prompt_short": Query(
        lambda v: v.articles.select("url", build_prompt("title", "content", ["health", "border"], 4000).alias("prompt")),
        r"""SELECT url, concat('You are a news article classifier. Classify the following article into exactly ONE of these categories:',
              E'\n\n- health\n- border\n\nArticle Title: ', title, E'\n\nArticle Content:\n',
              CASE WHEN length(content) > 4000 THEN concat(left(content, 4000), '...') ELSE content END,
              E'\n\nRespond with ONLY the category name, nothing else.') AS prompt FROM articles""",
    ),
    "normalize_category": Query(
        lambda v: v.errors.select("event_id", normalize_category(
            F.when(F.col("error_type") != "error", F.concat(F.lit(" "), F.col("error_type"), F.lit("\n")))
        ).alias("category")),
        "SELECT event_id, CASE WHEN error_type = 'error' THEN 'error' ELSE error_type END AS category FROM errors",
    ),
    "truncate_text": Query(
        lambda v: v.articles.select("url", truncate_text("content", 4000, "...").alias("content")),
        """SELECT url, CASE WHEN length(content) > 4000 THEN concat(left(content, 4000), '...') ELSE content END AS content
           FROM articles""",
    ),
}
