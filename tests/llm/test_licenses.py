from goldleaf.llm import licenses


def test_scan_cases(spark):
    isc = dict((k, t) for k, t in licenses.KNOWN)["ISC"]
    changed = "Copyright (c) 2020 A. Body\n(c) 2021 another\n\n" + isc.upper().replace("SOFTWARE", "software,").replace(" FEE", "  fee").replace('"AS IS"', "“as is”")
    docs = [(1, isc), (2, changed), (3, None), (4, ""), (5, "© 2020 me\n--\n"), (6, "x\n  licenced UNDER the apache licence; version 2.0\ny"),
            (7, "Released under the MIT License."), (7, "Released under the MIT License."), (None, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
            (8, isc + " more")]
    df = spark.createDataFrame([(i, t, "d") for i, t in docs], "doc_id long, text string, digest string")
    got = licenses.scan_licenses(df, licenses.known_digests(spark)).collect()
    rows = {}
    for r in got:
        rows.setdefault(r.doc_id, []).append((r.digest is not None, r.license_id, r.notice_ids, r.n_notices))
    assert rows[1] == rows[2] == [(True, "ISC", "", 0)]
    assert rows[3] == rows[4] == rows[5] == [(False, None, "", 0)]
    assert rows[6] == [(True, None, "Apache-2.0", 1)]
    assert rows[7] == [(True, "MIT", "MIT", 1)] * 2
    assert rows[None] == [(True, None, "CC-BY-NC-4.0", 2)]
    assert rows[8] == [(True, None, "", 0)]
    assert licenses.scan_licenses(df.limit(0), licenses.known_digests(spark)).count() == 0
    none = licenses.known_digests(spark).limit(0)
    assert {r.license_id for r in licenses.scan_licenses(df, none).collect()} == {None}


def test_whole_license_files(spark):
    """Files as they are found in repositories: with and without title, owner's lines, appendix."""
    kept = {i: licenses._kept(i) for i, _ in licenses.TITLED}
    apache, gpl = kept["Apache-2.0"], kept["GPL-3.0"]
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500)
    bsd = licenses._kept("BSD-3-Clause")
    two = bsd[:bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE"):]
    docs = [("MIT", "MIT License\n\nCopyright (c) 2020 A. Body\n\n" + mit), ("MIT", "The MIT License (MIT)\n\n(c) 2021 B\n\n" + mit), ("MIT", mit),
            ("ISC", "ISC License\n\nCopyright 2020 C\n\n" + licenses._ISC), ("Apache-2.0", apache.replace("[yyyy]", "2020")),
            ("Apache-2.0", apache[:apache.index("   APPENDIX")]), ("Apache-2.0", apache[apache.index("   TERMS AND"):]),
            ("GPL-3.0", gpl.split("\n", 2)[2]), ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, D\nAll rights reserved.\n\n" + bsd),
            ("BSD-2-Clause", "Copyright (c) 2020, D\n\n" + two), ("BSD-2-Clause", two.replace("1. ", "* ").replace("2. ", "* ")),
            (None, "MIT License"), (None, apache + gpl), *kept.items()]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string")
    known = licenses.known_digests(spark, licenses.KNOWN + licenses.whole_texts())
    got = {r.doc_id: r.license_id for r in licenses.scan_licenses(df, known).collect()}
    assert [got[i] for i in range(len(docs))] == [want for want, _ in docs]


def test_long_runs_of_punctuation_take_linear_time(spark):
    import time

    from pyspark.sql import functions as F

    texts = ["a " + "-" * 200_000 + " b", "-" * 200_000, "x" + " .\n" * 60_000 + "y", "p --\n-- q\n\n---\nr"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    started = time.time()
    got = {r["i"]: r["c"] for r in df.select("i", licenses.canonical_lines(F.col("t")).alias("c")).collect()}
    assert got == {0: "a b", 1: "", 2: "x\ny", 3: "p\nq\nr"} and time.time() - started < 30
