"""Whole-table behaviour of the corpus operators, against brute force in Python."""

import pytest

from echoloom.llm import near_dup, page_text


@pytest.mark.parametrize("copies", (2, 600))
def test_copies_without_an_article_keep_their_text(spark, copies):
    def page(body):
        return f"<body><div>Welcome to us</div><p>{body}</p><div>All rights kept</div></body>"

    repeated = [(1, "https://one.example.org/a", page("first"))] * copies
    neighbours = [(1000 + i, f"https://one.example.org/b{i:04}", page("second")) for i in range(copies)]
    alone = [(9000 + i, f"https://two.example.org/{i:04}", page("all alike")) for i in range(copies)]
    rows = repeated + neighbours + [(2, "https://one.example.org/c", page("third"))] + alone
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(1, "first")] * copies + [(i, "second") for i, _, _ in neighbours] + [(2, "third")] + [(i, "Welcome to us\n\nall alike\n\nAll rights kept") for i, _, _ in alone]
    assert sorted((r.page_id, r.text) for r in got) == sorted(want)


def test_similarities_that_the_size_classes_would_miss_are_refused(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for operator in (near_dup.near_duplicates, near_dup.keep_one_of_each):
        with pytest.raises(ValueError, match="at least 80"):
            operator(docs, percent=79)
