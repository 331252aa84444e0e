"""Layout nodes as a design tool exports them, derived from the elements of the crawled pages.

The nesting, text, links and images are those of the pages; names and style attributes are assigned from the
tag and the position of an element.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Expressions read alike by Spark and DuckDB, over (page_id, pos, parent_pos, ord, depth, tag, attrs, text).
LAYOUT_COLUMNS = {
    "name": "CASE tag WHEN 'h1' THEN 'Main heading 1' WHEN 'h2' THEN 'Heading 2' WHEN 'p' THEN 'Body text' WHEN 'a' THEN 'nav cta' WHEN 'li' THEN concat('Item', ord) "
    "WHEN 'ul' THEN 'Cards grid' WHEN 'img' THEN 'Hero image' WHEN 'section' THEN 'Stats' WHEN 'b' THEN 'description' WHEN 'footer' THEN 'Price Table' WHEN 'nav' THEN 'nav_menu' ELSE tag END",
    "href": "CASE WHEN tag = 'a' THEN coalesce(nullif(regexp_extract(attrs, 'href=\"([^\"]*)\"', 1), ''), '/') END",
    "src": "CASE WHEN tag IN ('img', 'video') THEN coalesce(nullif(regexp_extract(attrs, 'src=\"([^\"]*)\"', 1), ''), '/') END",
    "display": "CASE WHEN tag = 'article' AND page_id % 3 = 0 THEN 'grid' END",
    "component_id": "CASE WHEN tag = 'footer' THEN concat('foot-', page_id % 4) END",
    "component_name": "CASE WHEN tag = 'nav' AND page_id % 5 = 0 THEN 'Menu' END",
    "background_image": "CASE WHEN tag = 'div' AND pos % 11 = 5 THEN concat('url(/bg-', pos % 4, '.png)') END",
    "grid_columns": "CASE WHEN tag = 'ul' AND pos % 4 = 0 THEN '200px 1fr' END",
    "grid_rows": "CASE WHEN tag = 'ul' AND pos % 4 = 1 THEN 'auto 1fr' END",
    "width": "CASE WHEN tag IN ('div', 'img', 'ul', 'p') THEN CASE pos % 4 WHEN 0 THEN '100%' WHEN 1 THEN concat(40 + pos, 'px') WHEN 2 THEN 'auto' END END",
    "height": "CASE WHEN tag IN ('img', 'article') THEN CASE pos % 3 WHEN 0 THEN '50vh' WHEN 1 THEN '12.5rem' ELSE 'fit-content' END END",
    "max_width": "CASE WHEN tag IN ('div', 'section', 'article') AND pos % 3 = 1 THEN concat(600 + 20 * (pos % 10), 'px') END",
    "border_radius": "CASE WHEN tag IN ('div', 'b', 'img') THEN CASE pos % 5 WHEN 0 THEN '4px' WHEN 1 THEN '4px 8px' WHEN 2 THEN '1px 2px 3px' WHEN 3 THEN '1px 2px 3px 4%' END END",
    "font_weight": "CASE WHEN tag IN ('h1', 'b') THEN concat(300 + 100 * (pos % 6), '') END",
    "font_family": "CASE WHEN tag IN ('h1', 'h2', 'p') THEN CASE pos % 3 WHEN 0 THEN concat('''Brand Sans''', ', serif') WHEN 1 THEN 'Inter' END END",
    "letter_spacing": "CASE WHEN tag IN ('h2', 'p') AND pos % 3 = 2 THEN '-0.02em' END",
    "right_offset": "CASE WHEN tag = 'nav' AND page_id % 3 = 0 THEN '10%' END",
    "bottom_offset": "CASE WHEN tag = 'div' AND pos % 10 = 0 THEN '-4px' END",
    "left_offset": "CASE WHEN tag = 'div' AND pos % 10 = 5 THEN 'auto' END",
    "stack_direction": "CASE WHEN tag IN ('div', 'nav', 'article', 'footer') THEN CASE WHEN pos % 2 = 0 THEN 'vertical' ELSE 'horizontal' END END",
    "stack_gap": "CASE WHEN tag IN ('div', 'ul', 'article') AND pos % 3 > 0 THEN concat(4 * (pos % 9), 'px') END",
    "padding": "CASE WHEN tag IN ('div', 'section') THEN CASE pos % 3 WHEN 0 THEN '10px' WHEN 1 THEN '40px 20px' ELSE '1px 2px 3px 4px' END END",
    "background": "CASE WHEN tag IN ('div', 'section') AND pos % 2 = 0 THEN '#FF6600' END",
    "font_size": "CASE WHEN tag IN ('h1', 'h2', 'p', 'b') AND pos % 3 = 0 THEN concat(12 + 4 * (pos % 7), 'px') END",
    "line_height": "CASE WHEN tag IN ('h1', 'p') THEN CASE pos % 3 WHEN 0 THEN '1.5' WHEN 1 THEN '150%' ELSE '24px' END END",
    "color": "CASE WHEN tag IN ('h1', 'h2', 'p') AND pos % 4 = 0 THEN 'rgb(17, 17, 17)' END",
    "text_style": "CASE WHEN tag IN ('h1', 'h2', 'p', 'b') AND pos % 2 = 0 THEN concat('/Text/', pos % 5) END",
    "opacity": "CASE WHEN tag = 'b' THEN '0.5' END",
    "position": "CASE WHEN tag = 'nav' THEN 'absolute' WHEN tag = 'div' AND pos % 5 = 0 THEN 'sticky' END",
    "top_offset": "CASE WHEN tag = 'nav' AND page_id % 2 = 0 THEN '0px' END",
    "caption": "CASE WHEN tag = 'footer' THEN text END",
    "variant": "CASE WHEN tag = 'footer' THEN concat('variant', page_id % 4) END",
}


def layout_nodes(elements: DataFrame) -> DataFrame:
    """(page_id, pos, parent_pos, ord, depth, tag, text, ...attributes)."""
    return elements.select(
        "page_id", "pos", "parent_pos", "ord", "depth", "tag", "text", *[F.expr(sql).cast("string").alias(name) for name, sql in LAYOUT_COLUMNS.items()]
    )


# Named text styles of a site's design file; n is the style number.
TEXT_STYLE_COLUMNS = (
    "site", "concat('/Text/', n) AS name", "concat(14 + 6 * n, 'px') AS font_size", "concat(400 + 100 * n, '') AS font_weight",
    "CASE WHEN n = 2 THEN NULL ELSE '#222222' END AS color", "CASE WHEN n % 2 = 0 THEN 'Inter, sans-serif' ELSE '\"Open Sans\"' END AS font_family",
)


def text_styles(pages_with_site: DataFrame) -> DataFrame:
    """Four named styles per site (nodes also name a fifth, which is missing)."""
    s = pages_with_site.select("site").distinct()
    return s.withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(4)]))).selectExpr(*TEXT_STYLE_COLUMNS)
