"""Queries on course catalogue pages made from the part and supplier tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import details
from .registry import query

CODE = "'MAT' || lpad((p_partkey % 10000)::VARCHAR, 4, '0')"


def _code():
    return F.concat(F.lit("MAT"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"))


def _text(c):
    """A column as the text of an HTML element."""
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query(
    f"""SELECT 'unit ' || p_size AS unit, p_partkey::VARCHAR AS component_id, {CODE} AS code, p_name AS name,
    CASE WHEN p_partkey % 2 = 0 THEN '( ' || p_brand || ' (ABC1000) E FIS1001 )' END AS prerequisites, CASE WHEN p_partkey % 2 = 0 THEN '-' END AS corequisites,
    CASE WHEN p_partkey % 2 = 0 THEN p_type END AS equivalences, CASE WHEN p_partkey % 2 = 0 THEN 'one | two' END AS required_by, p_partkey % 3 = 0 AS has_programme, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS body FROM part"""
)
def component_scrape(load):
    """Listings of a unit's components, on pages that grow no longer with the table, detail pages of every other one, programmes of every third."""
    part = load("part")
    line = F.concat(
        F.lit("<tr><td>"), _code(), F.lit("</td><td>"), _text(F.col("p_name")), F.lit("</td><td><a title='Programa Atual do Componente' onclick=\"go({'idComponente' : '"), "p_partkey", F.lit("'})\">p</a></td></tr>")
    )
    listings = part.groupBy("p_size", F.expr("p_partkey div 5000").alias("page")).agg(F.array_join(F.collect_list(line), "").alias("rows"))
    listings = listings.select(F.concat(F.lit("unit "), "p_size").alias("unit"), F.concat(F.lit("<table class=listagem><tbody>"), "rows", F.lit("<tr><td>X<td>no link</tr></tbody></table>")).alias("html"))
    page = F.concat(
        F.lit("<table><caption>Dados Gerais do Componente Curricular</caption><tr><th>Pré-Requisitos:</th><td>( <acronym title='ABC1000 - "), "p_brand",
        F.lit("'>ABC1000</acronym> e FIS1001 )</td></tr><tr><th>Equivalências:</th><td>"), _text(F.col("p_type")),
        F.lit("</td></tr></table><table><caption>Outros componentes que têm esse componente como pré-requisito</caption><tr><td>one</td></tr><tr><td>two</td></tr></table>"),
    )
    key = F.col("p_partkey").cast("string").alias("component_id")
    return details.scraped(listings, part.where("p_partkey % 2 = 0").select(key, page.alias("html")), part.where("p_partkey % 3 = 0").select(key, F.col("p_name").alias("html")))


@query(
    """SELECT s_suppkey::VARCHAR AS unit, '2025.1' AS period, '<!DOCTYPE html><html><body><div id="turmasAbertas"><table class="listagem"><caption>1 turmas encontrada(s)</caption><tr><td>' || replace(replace(s_name, '&', '&amp;'), '<', '&lt;')
    || '</td></tr></table></div></body></html>' AS body FROM supplier WHERE s_suppkey % 2 = 0"""
)
def offerings_scrape(load):
    """Result pages, of which every other one found nothing."""
    found = F.concat(F.lit("<table class='listagem'><caption>1 turmas encontrada(s)</caption><tr><td>"), _text(F.col("s_name")), F.lit("</td></tr></table>"))
    html = F.concat(F.lit("<body><nav>menu</nav><div id=turmasAbertas>"), F.when(F.col("s_suppkey") % 2 == 0, found).otherwise("none"), F.lit("</div></body>"))
    return details.offering_pages(load("supplier").select(F.col("s_suppkey").cast("string").alias("unit"), F.lit("2025.1").alias("period"), html.alias("html")))
