"""Document queries over pages, documents and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import documents
from specloom.plans.registry import query, table

HREF = 'href="([^"]*)"'

# A page is named after the first part of its path; its links lead to names.
LINKS_SQL = f"""SELECT CAST(page_id AS VARCHAR) AS page, '/' || split_part(url, '/', 4) AS source,
    trim(unnest(regexp_extract_all(html, '{HREF}', 1))) AS target FROM pages"""
PAGES_SQL = "SELECT '/' || split_part(url, '/', 4) AS name, url AS location FROM pages"


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"), "url")


def _name():
    return F.concat(F.lit("/"), F.split_part(F.col("url"), F.lit("/"), F.lit(4)))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = page_texts(spark, sf_dir).select(F.col("page_id").alias("page"), "text")
    return documents.extract_links(docs, HREF, skip_code=False)


def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(_name().alias("name"), F.col("url").alias("location"))


@query("links_html", f"SELECT page_id AS page, trim(unnest(regexp_extract_all(html, '{HREF}', 1))) AS target FROM pages")
def links_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir)


LINK_FINDINGS_SQL = f"""
    SELECT CASE WHEN n IS NULL THEN 'ERROR' ELSE 'WARN' END AS severity, page,
           CASE WHEN n IS NULL THEN 'missing page' ELSE 'ambiguous page' END AS rule, target AS detail,
           coalesce(n, 0) AS n_locations
    FROM ({LINKS_SQL}) LEFT JOIN (SELECT name, count(*) AS n FROM ({PAGES_SQL}) GROUP BY name) ON name = target
    WHERE n IS NULL OR n > 1
"""


@query("link_findings", LINK_FINDINGS_SQL)
def link_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.resolve_links(page_links(spark, sf_dir), page_names(spark, sf_dir))


@query("ambiguous_locations", f"""
    SELECT name AS target, location FROM ({PAGES_SQL}) WHERE name IN (SELECT target FROM ({LINKS_SQL}))
    AND name IN (SELECT name FROM ({PAGES_SQL}) GROUP BY name HAVING count(*) > 1)
""")
def ambiguous_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.ambiguous_locations(page_links(spark, sf_dir), page_names(spark, sf_dir))


# Each document with index entries for its source folder, a word, and a web address.
INDEX_DOCS_SQL = r"""
    SELECT CAST(doc_id AS VARCHAR) AS page, source, lang, n_chars, text,
           '- `' || source || '/' || lang || '.md`: text' || chr(10) || '- `plain`: word' || chr(10)
           || '- `https://example.com/' || source || '`: web' || chr(10) || text || chr(10)
           || '- `' || lang || '\' || source || '`: folder' AS index_text
    FROM documents
"""


def index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    entry = F.concat(
        F.lit("- `"), "source", F.lit("/"), "lang", F.lit(".md`: text\n- `plain`: word\n- `https://example.com/"),
        "source", F.lit("`: web\n"), "text", F.lit("\n- `"), "lang", F.lit("\\"), "source", F.lit("`: folder"),
    )
    return docs.select(F.col("doc_id").cast("string").alias("page"), entry.alias("text"))


MISSING_REFS_SQL = rf"""
    SELECT 'ERROR' AS severity, page, 'missing path' AS rule, candidate AS detail
    FROM (SELECT page, regexp_extract(line, '^-\s+`([^`]+)`:', 1) AS candidate
          FROM (SELECT page, unnest(string_split(index_text, chr(10))) AS line FROM ({INDEX_DOCS_SQL})))
    WHERE (contains(candidate, '/') OR contains(candidate, '\')) AND NOT starts_with(candidate, 'https://')
      AND replace(candidate, '\', '/') NOT IN (
          SELECT source || '/' || lang || '.md' FROM documents WHERE n_chars > 5000)
"""


@query("missing_refs", MISSING_REFS_SQL)
def missing_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = table(spark, sf_dir, "documents").filter(F.col("n_chars") > 5000)
    manifest = long.select(F.concat("source", F.lit("/"), "lang", F.lit(".md")).alias("path"))
    return documents.missing_refs(index_docs(spark, sf_dir), manifest)


# Documents whose frame depends on their language; 'es' ones are templates.
STRUCTURE_DOCS_SQL = """
    SELECT CASE WHEN lang = 'es' THEN source || '/_' || doc_id ELSE source || '/' || doc_id END AS page,
           CASE WHEN lang = 'en' THEN '---' || chr(10) ELSE '' END || text
           || CASE WHEN lang <> 'de' THEN chr(10) || '## Related Links' ELSE '' END
           || CASE WHEN n_chars > 500 THEN chr(10) || '## Provenance' || chr(10) || '## Last Updated' ELSE '' END AS text
    FROM documents
"""


def structured_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.when(lang == "es", "/_").otherwise("/"), "doc_id").alias("page"),
        F.concat(
            F.when(lang == "en", "---\n").otherwise(""), "text",
            F.when(lang != "de", "\n## Related Links").otherwise(""),
            F.when(F.col("n_chars") > 500, "\n## Provenance\n## Last Updated").otherwise(""),
        ).alias("text"),
    )


STRUCTURE_SQL = f"""
    SELECT severity, page, 'structure' AS rule, detail FROM (
        SELECT page, unnest(['ERROR', 'WARN', 'WARN', 'WARN']) AS severity,
               unnest(['front matter', 'Related Links', 'Provenance', 'Last Updated']) AS detail,
               unnest([starts_with(text, '---' || chr(10)), contains(text, '## Related Links'),
                       contains(text, '## Provenance'), contains(text, '## Last Updated')]) AS fine
        FROM ({STRUCTURE_DOCS_SQL}) WHERE NOT contains(page, '/_'))
    WHERE NOT fine
"""


@query("doc_structure", STRUCTURE_SQL)
def doc_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.structure_findings(structured_docs(spark, sf_dir))


# Documents as logs: a heading, then their lines as bullets or as headings.
LOG_DOCS_SQL = r"""
    SELECT CAST(doc_id AS VARCHAR) AS page, lang,
           '2024-0' || (n_chars % 9 + 1) || '-1' || (doc_id % 9) AS day,
           CASE lang WHEN 'en' THEN 'ingest' WHEN 'fr' THEN 'query' WHEN 'de' THEN 'lint' ELSE 'other' END AS kind,
           CASE lang WHEN 'de' THEN '## ' ELSE '- ' END AS lead, text
    FROM documents
"""


def log_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    day = F.concat(F.lit("2024-0"), F.col("n_chars") % 9 + 1, F.lit("-1"), F.col("doc_id") % 9)
    kind = F.when(lang == "en", "ingest").when(lang == "fr", "query").when(lang == "de", "lint").otherwise("other")
    lead = F.when(lang == "de", "\n## ").otherwise("\n- ")
    body = F.concat(F.lit("## ["), day, F.lit("] "), kind, F.lit(" | "), F.replace(F.col("text"), F.lit("\n"), lead))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("page"), body.alias("text"))


HEADINGS_SQL = rf"""
    SELECT 'WARN' AS severity, page, 'heading' AS rule, line_no || ': ' || line AS detail
    FROM (SELECT page, unnest(string_split(body, chr(10))) AS line,
                 unnest(range(1, len(string_split(body, chr(10))) + 1)) AS line_no
          FROM (SELECT page, '## [' || day || '] ' || kind || ' | ' || replace(text, chr(10), chr(10) || lead) AS body
                FROM ({LOG_DOCS_SQL})))
    WHERE starts_with(line, '## ')
      AND NOT regexp_matches(line, '^## \[\d{{4}}-\d{{2}}-\d{{2}}\] (ingest|query|lint) \| .+')
"""


@query("heading_check", HEADINGS_SQL)
def heading_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.heading_findings(log_docs(spark, sf_dir))


@query("log_timeline", f"""
    SELECT CAST(day AS DATE) AS day, kind, count(*) AS n, CAST(sum(CASE WHEN lang = 'de' THEN 0
               ELSE len(text) - len(replace(text, chr(10), '')) END) AS BIGINT) AS n_bullets
    FROM ({LOG_DOCS_SQL}) WHERE kind <> 'other' AND regexp_matches(text, '^[^\\n]') GROUP BY day, kind
""")
def log_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.log_timeline(documents.parse_log(log_docs(spark, sf_dir)))


@query("lint_summary", f"""
    SELECT severity, count(*) AS n, severity = 'ERROR' AS failed FROM (
        SELECT severity FROM ({LINK_FINDINGS_SQL}) UNION ALL SELECT severity FROM ({MISSING_REFS_SQL})
        UNION ALL SELECT severity FROM ({STRUCTURE_SQL}) UNION ALL SELECT severity FROM ({HEADINGS_SQL}))
    GROUP BY severity
""")
def lint_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [link_findings, missing_refs, doc_structure, heading_check]
    return documents.lint_summary(documents.lint_report([check(spark, sf_dir) for check in checks]))


@query("missing_members", """
    SELECT 'customer/' || c_custkey AS path FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def missing_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer/"), "c_custkey").alias("path"))
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return documents.missing_members(required, urgent.select(F.concat(F.lit("customer/"), "o_custkey").alias("path")))


@query("merge_conversation", """
    SELECT conv_id AS doc, count(*) AS n_pages,
           string_agg('<!-- source: page-' || turn || '_' || role || '.md -->' || chr(10) || '## Page '
                      || lpad(CAST(turn AS VARCHAR), 3, '0') || chr(10) || chr(10) || trim(text, chr(10) || ' '),
                      chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) || chr(10) AS text
    FROM conversations WHERE trim(text, chr(10) || ' ') <> '' GROUP BY conv_id
""")
def merge_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc"), F.concat(F.lit("page-"), "turn", F.lit("_"), "role", F.lit(".md")).alias("name"), "text"
    )
    return documents.merge_pages(pages)


# Pages as they may come: a NULL document, a missing text, a page that is there twice.
_ODD_PAGES_SQL = """
    SELECT CASE WHEN conv_id % 7 = 0 THEN NULL ELSE conv_id END AS doc, turn, role, name, text FROM (
        SELECT conv_id, turn, role, 'page-' || turn || '_' || role || '.md' AS name,
               CASE WHEN conv_id % 11 = 0 AND turn = 1 THEN NULL ELSE text END AS text FROM conversations
        UNION ALL
        SELECT conv_id, turn, role, 'page-' || turn || '_' || role || '.md', text FROM conversations WHERE conv_id % 5 = 0)"""


@query("merge_parts", f"""
    SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY turn, body) AS part_no, body AS text FROM (
        SELECT *, '<!-- source: ' || name || ' -->' || chr(10) || '## Page ' || lpad(CAST(turn AS VARCHAR), 3, '0')
                  || chr(10) || chr(10) || trim(text, chr(10) || ' ') AS body
        FROM ({_ODD_PAGES_SQL}) WHERE trim(text, chr(10) || ' ') <> '')
""")
def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").withColumn(
        "name", F.concat(F.lit("page-"), "turn", F.lit("_"), "role", F.lit(".md"))
    )
    missing = (F.col("conv_id") % 11 == 0) & (F.col("turn") == 1)
    pages = own.withColumn("text", F.when(~missing, F.col("text"))).unionByName(own.filter("conv_id % 5 = 0"))
    parts = documents.merge_parts(pages.select(
        F.when(F.col("conv_id") % 7 != 0, F.col("conv_id")).alias("doc"), "name", "text"
    ))
    return parts.select("doc", "part_no", "text")


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), "html")
    return documents.extract_sections(pages, section=None)


def _plain_sql(markup: str) -> str:
    """Markup to text: tags out, the entities that occur decoded, blanks collapsed."""
    text = f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
        text = f"replace({text}, '{entity}', '{char}')"
    text = f"regexp_replace({text}, '&amp;?', '&', 'g')"  # the closing mark may be missing
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


@query("page_titles", f"""
    SELECT page_id AS page, {_plain_sql("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)")} AS title FROM pages
""")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_sections(spark, sf_dir).select("page", "title")


@query("page_bullets", f"""
    SELECT page, CAST(bullet_no AS INTEGER) AS bullet_no, {_plain_sql('item')} AS bullet
    FROM (SELECT page_id AS page, unnest(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1)) AS item,
                 unnest(range(1, len(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1)) + 1)) AS bullet_no FROM pages)
""")
def page_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_sections(spark, sf_dir).select("page", F.posexplode("bullets").alias("_at", "bullet")).select(
        "page", (F.col("_at") + 1).alias("bullet_no"), "bullet"
    )


@query("page_paragraphs")
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs nest where the markup leaves them open, which no SQL pattern can follow."""
    return page_sections(spark, sf_dir).select("page", F.posexplode("paragraphs").alias("paragraph_no", "paragraph"))


_SECTION_SQL = """
    SELECT p_partkey AS page, CAST(section_no AS INTEGER) AS section_no, p_name, p_brand, p_type, p_size
    FROM part, (SELECT unnest([1, 2]) AS section_no)"""


def _part_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of pages made of parts, two alike on each page but for the number in their texts."""
    def section(number: int) -> Column:
        return F.concat(
            F.lit(f'<section class="slide s{number}"><p class="eyebrow">'), "p_brand", F.lit(f" {number}</p><h2>"), "p_name",
            F.lit(' &amp; <em>more</em></h2><p class="lead">Lead of\n '), "p_type", F.lit('</p><p class="meta">'), "p_size",
            F.lit("</p><ul><li>one</li><li>two</li></ul>"),
            F.lit('<div class="card"><span class="badge">'), "p_brand", F.lit("</span><h3>"), "p_name",
            F.lit("</h3><p>Size<br>"), "p_size", F.lit('</p></div><div class="card"><h3>'), "p_type", F.lit("</h3></div>"),
            F.lit("<table><tr><th>type</th><th>size</th></tr><tr><td>"), "p_type", F.lit("</td><td>"), "p_size",
            F.lit(f"</td></tr></table><p>Text {number} of "), "p_name", F.lit(".</p></section>"),
        )

    # parts are small and lie in few files: they are spread over the tasks before they become pages
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    pages = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey").select(
        F.col("p_partkey").alias("page"),
        F.concat(F.lit("<html><body><nav>x</nav>"), section(1), section(2), F.lit("</body></html>")).alias("html"),
    )
    return documents.extract_sections(pages)


@query("section_fields", f"""
    SELECT page, section_no, p_name || ' & more' AS title, p_brand || ' ' || section_no AS eyebrow,
           'Lead of ' || p_type AS lead, CAST(p_size AS VARCHAR) AS meta FROM ({_SECTION_SQL})
""")
def section_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_sections(spark, sf_dir).select("page", "section_no", "title", "eyebrow", "lead", "meta")


@query("section_cards", f"""
    SELECT page, section_no, CAST(unnest([1, 2]) AS INTEGER) AS card_no, unnest([p_brand, '']) AS badge,
           unnest([p_name, p_type]) AS title, unnest(['Size ' || p_size, '']) AS body FROM ({_SECTION_SQL})
""")
def section_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_sections(spark, sf_dir).select("page", "section_no", F.posexplode("cards").alias("_at", "card")).select(
        "page", "section_no", (F.col("_at") + 1).alias("card_no"), "card.badge", "card.title", "card.body"
    )


@query("section_tables", f"""
    SELECT page, section_no, CAST(unnest([1, 2]) AS INTEGER) AS row_no, unnest(['type', p_type]) AS first_cell,
           unnest(['size', CAST(p_size AS VARCHAR)]) AS second_cell FROM ({_SECTION_SQL})
""")
def section_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part_sections(spark, sf_dir).select("page", "section_no", F.explode("tables").alias("rows"))
    return rows.select("page", "section_no", F.posexplode("rows").alias("_at", "cells")).select(
        "page", "section_no", (F.col("_at") + 1).alias("row_no"), F.get("cells", F.lit(0)).alias("first_cell"),
        F.get("cells", F.lit(1)).alias("second_cell"),
    )


@query("section_paragraphs", f"""
    SELECT page, section_no, CAST(unnest([1, 2]) AS INTEGER) AS paragraph_no,
           unnest(['Size ' || p_size, 'Text ' || section_no || ' of ' || p_name || '.']) AS paragraph FROM ({_SECTION_SQL})
""")
def section_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_sections(spark, sf_dir).select(
        "page", "section_no", F.posexplode("paragraphs").alias("_at", "paragraph")
    ).select("page", "section_no", (F.col("_at") + 1).alias("paragraph_no"), "paragraph")


@query("link_orphans", f"SELECT name, location FROM ({PAGES_SQL}) WHERE name NOT IN (SELECT target FROM ({LINKS_SQL}))")
def link_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.orphan_pages(page_links(spark, sf_dir), page_names(spark, sf_dir))


@query("link_one_way", f"""
    WITH links AS (SELECT DISTINCT source, target FROM ({LINKS_SQL}))
    SELECT source, target FROM links a
    WHERE NOT EXISTS (SELECT 1 FROM links b WHERE b.source = a.target AND b.target = a.source)
""")
def link_one_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), _name().alias("source"))
    return documents.one_way_links(page_links(spark, sf_dir).join(names, "page"))
