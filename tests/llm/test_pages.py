"""Page text: articles keep what they quote, against brute force for neighbours and alignments."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from gustmill.llm import html_pages, queries

SCHEMA = "page_id long, url string, html string, key string, part int"


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "own", 7) for r in rows], SCHEMA).repartition(3)
    return {r.page_id: r.text for r in html_pages.extracted(df).collect()}


def test_headings_and_sentences_of_an_article_stay_though_a_neighbour_has_them(spark):
    page = (
        "<body><p>site line</p><article><h1>One head</h1><p>A quoted passage, that both have, ends here.</p>"
        "<p>Long text of page {0} alone, which makes up most of it and is told at length {0}.</p><h2>Part</h2><p>Read more</p></article>"
    )
    found = texts(spark, [(i, f"http://h/{i}", page.format(i)) for i in (1, 2)])
    for i in (1, 2):
        assert found[i].split("\n") == [
            "One head",
            "A quoted passage, that both have, ends here.",
            f"Long text of page {i} alone, which makes up most of it and is told at length {i}.",
            "Part",
        ]


def test_no_page_of_the_table_loses_a_line_of_its_article(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.page_id: r.text for r in queries.queries()["op7_html_text"](spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/pages.parquet").collect():
        own = [line[0] for line in html_pages.page_lines(row.html or "") if line[2] and not line[1]]
        assert found[row.page_id] == "\n\n".join(own)


def test_odd_pages(spark):
    long = "<p>" + "word " * 200_000 + "</p>" + "<p>line</p>" * 20_000
    rows = [(1, None, None), (2, "http://h/a", ""), (3, "http://h/a", "<p>x</p>"), (3, "http://h/a", "<p>x</p>"), (None, "nothing", "<p>y &amp; z"), (5, "http://g/", long)]
    found = texts(spark, rows)
    assert found[1] == found[2] == "" and found[None] == "y & z" and len(found[5]) == 200_000 * 5 - 1 + 5 * 20_000
    assert html_pages.extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_alignments_are_longest():
    rng = np.random.default_rng(1)
    for _ in range(200):
        one, two = ([str(x) for x in rng.integers(0, 6, rng.integers(0, 14))] for _ in range(2))

        @lru_cache(None)
        def longest(i, j, one=tuple(one), two=tuple(two)):
            if i == len(one) or j == len(two):
                return 0
            if one[i] == two[j]:
                return 1 + longest(i + 1, j + 1)
            return max(longest(i + 1, j), longest(i, j + 1))

        shared = sorted(html_pages.shared_lines(one, two))
        assert len(shared) == longest(0, 0)
        rest = iter(two)
        assert all(one[i] in rest for i in shared)  # in order


def test_the_chosen_neighbour_shares_the_longest_beginning():
    rng = np.random.default_rng(2)
    paths = sorted("".join(rng.choice(list("ab/"), 6)) for _ in range(60))
    common = lambda a, b: len(os.path.commonprefix((a, b)))
    for n, path in enumerate(paths):
        sides = [paths[n - 1] if n else None, paths[n + 1] if n + 1 < len(paths) else None]
        chosen = sides[html_pages.nearest(path, *sides)]
        assert common(path, chosen) == max(common(path, other) for k, other in enumerate(paths) if k != n)
    assert html_pages.nearest("x", None, None) == -1
