from lotwise.llm.url_filter import Rule, url_filter

PAGES = "page_id bigint, url string, gram string, n int"


def judged(spark, urls, **options):
    pages = spark.createDataFrame([(i, u, "g", 1) for i, u in urls], PAGES)
    return sorted((tuple(r) for r in url_filter(pages, **options).collect()), key=repr)


def test_parts_and_rules(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?q"), (2, "https://example.net/de/"), (3, "http://example.net/EN/"), (4, "ftp://org/fr/?a"),
        (5, "http://x.example.com/de/1#f"), (6, "http://notexample.com/de/"), (7, "http://a.net?x://b/c"), (8, "no scheme"),
        (9, None), (10, ""), (11, "http://net/"), (12, "http://Ü.org/fr/é"), (13, "a://b://c/d"), (14, "http://a.net:80/x"),
    ]
    got = {r[0]: r[1:4] for r in judged(spark, urls)}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/"), 2: ("example.net", "/de/", "net/"), 3: ("example.net", "/EN/", "net/"),
        4: ("org", "/fr/", "org/fr/"), 5: ("x.example.com", "/de/1", "example.com/de/"), 6: ("notexample.com", "/de/", None),
        7: ("a.net", "", None), 8: ("", "", None), 9: ("", "", None), 10: ("", "", None), 11: ("net", "/", "net/"),
        12: ("Ü.org", "/fr/é", "org/fr/"), 13: ("b:", "//c/d", None), 14: ("a.net:80", "/x", None),
    }


def test_verdicts_follow_rules_and_examples(spark):
    rules = (Rule("allow", "good.org", "/"), Rule("block", "bad.com", "/"))
    urls = [(i, f"http://good.org/story-about-cats/{i}/{'ab'[i % 2]}") for i in range(60)]
    urls += [(100 + i, f"http://bad.com/casino~bonus~{i}~{'xy'[i % 2]}") for i in range(60)]
    urls += [(200, "http://else.net/story-about-cats/7/a"), (201, "http://else.net/casino~bonus~7~x")]
    got = {r[0]: r[4] for r in judged(spark, urls, rules=rules)}
    assert all(got[i] == "allow" for i in range(60)) and all(got[100 + i] == "block" for i in range(60))
    assert (got[200], got[201]) == ("allow", "block")


def test_repeated_rows_and_no_examples(spark):
    urls = [(1, "http://a.b/c")] * 5 + [(1, "http://a.b/d"), (None, "http://a.b/c"), (None, None), (None, None)]
    got = judged(spark, urls)
    assert len(got) == len(urls)
    assert sum(r[:3] == (1, "a.b", "/c") for r in got) == 5
    assert sum(r[:3] == (None, "", "") for r in got) == 2
    assert {r[4] for r in got} == {"allow"}  # equal models, threshold 0


def test_long_url_and_empty_table(spark):
    assert judged(spark, [(1, "http://h/" + "a1/" * 30_000)])[0][1] == "h"
    assert judged(spark, []) == []
