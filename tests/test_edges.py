from datetime import date

from pyspark.sql import functions as F

from conftest import commercial, crosswalk, frame, medicare, rows_of
from provgraph.operators import edges as E
from provgraph.sources import schemas as S

R, B, FAC = 11, 21, 31  # NPIIDs
XW = [(R, 1011, None), (B, 1021, 5), (FAC, 1031, 6), (41, 1041, 7)]


def test_billing_edges_dedup_and_count(spark, cfg):
    claims = commercial(spark, [
        (2016, 20160105, R, B, FAC, 1),
        (2016, 20160105, R, B, FAC, 1),  # exact duplicate: counted once
        (2016, 20160120, R, B, None, 2),
        (2016, 20160220, R, B, None, 2),
        (2015, 20150220, R, B, None, 2),  # before the first claim year
        (2016, 20160220, R, R, None, 3),  # billing = rendering
        (2016, 20160220, R, None, FAC, 4),  # no billing id
    ])
    out = E.commercial_edges(claims, crosswalk(spark, XW), cfg, "billing")
    assert rows_of(out, *E.EDGE_COLUMNS) == [
        (1011, date(2016, 1, 1), 1021, 2, date(2016, 1, 5), date(2016, 1, 20)),
        (1011, date(2016, 2, 1), 1021, 1, date(2016, 2, 20), date(2016, 2, 20)),
    ]


def test_facility_predicate_q1(spark, cfg):
    claims = commercial(spark, [
        (2016, 20160105, R, None, FAC, 1),  # NULL billing -> compared with 0, kept
        (2016, 20160105, R, FAC, FAC, 2),  # facility = billing, dropped
        (2016, 20160105, R, B, R, 3),  # facility = rendering, kept (Q1)
    ])
    out = E.commercial_edges(claims, crosswalk(spark, XW), cfg, "service_facility")
    assert rows_of(out, "org_npi", "claims") == [(1011, 1), (1031, 1)]


def test_claim_year_is_hidden_key_and_bad_date_null_month(spark, cfg):
    claims = commercial(spark, [
        (2016, 20170115, R, B, None, 1),  # month from claim year 2016
        (2017, 20170115, R, B, None, 1),  # same date, other claim year
        (2016, 20161301, R, B, None, 1),  # month 13 -> NULL date and month
        (2017, 20170432, R, B, None, 1),  # day 32 -> NULL date and month
    ])
    out = E.commercial_edges(claims, crosswalk(spark, XW), cfg, "billing")
    got = rows_of(out.fillna({"claims": 0}), "claim_month", "claims")
    assert (date(2016, 1, 1), 1) in got and (date(2017, 1, 1), 1) in got
    # two NULL-month rows survive because claim year stays a group key
    assert sum(1 for m, _ in got if m is None) == 2


def test_both_roles_in_one_pass_equal_separate(spark, cfg):
    claims = commercial(spark, [
        (2016, 20160105, R, B, FAC, 1),
        (2016, 20160305, R, B, 41, 2),
        (2016, 20160305, R, None, 41, 3),
    ])
    xw = crosswalk(spark, XW)
    both = E.commercial_edges_by_role(E.commercial_claim_grain(claims, xw, cfg))
    for role in ("billing", "service_facility"):
        one = E.commercial_edges(claims, xw, cfg, role)
        assert rows_of(both.filter(F.col("org_role") == role), *E.EDGE_COLUMNS) == rows_of(one, *E.EDGE_COLUMNS)


def avail(spark, rows):
    return frame(spark, S.MEDICARE_AVAILABILITY, [(v, r, date(v, 12, 31)) for v, r in rows])


def test_vintage_selection_q14(spark, cfg):
    sel = E.select_vintages(
        avail(spark, [(2015, "annual"), (2016, "annual"), (2017, "annual"), (2017, "quarterly"), (2018, "quarterly")]),
        cfg,
    )
    assert rows_of(sel, "vintage", "release") == [(2016, "annual"), (2017, "annual"), (2018, "quarterly")]
    # no annual year at all is legal
    only_q = E.select_vintages(avail(spark, [(2019, "quarterly"), (2020, "quarterly")]), cfg)
    assert rows_of(only_q, "vintage", "release") == [(2019, "quarterly"), (2020, "quarterly")]


D = date(2017, 3, 4)


def test_medicare_events_per_claim_type_distinct_q5(spark, cfg):
    claims = medicare(spark, [
        (2017, "annual", "inp", D, "100", "", None, "500", 9),
        (2017, "annual", "inp", D, "100", "", None, "500", 9),  # duplicate in one type: once
        (2017, "annual", "out", D, "100", "", None, "500", 9),  # same visit, other type: again
    ])
    ev = E.medicare_events(E.medicare_claim_grain(claims), ("attending",))
    assert ev.count() == 2
    edges = E.medicare_edges_by_role(ev)
    assert rows_of(edges, "physician_npi", "claim_month", "org_npi", "claims") == [(100, date(2017, 3, 1), 500, 2)]


def test_medicare_role_predicates_q6_q7(spark, cfg):
    claims = medicare(spark, [
        # attending blank -> 0, dropped by the attending zero filter
        (2017, "annual", "inp", D, "", "200", None, "500", 1),
        # operating equals attending -> not an operating edge
        (2017, "annual", "inp", D, "300", "300", None, "500", 2),
        # operating with NULL attending compares with '0'
        (2017, "annual", "inp", D, None, "400", "", "500", 3),
        # rendering blank -> NPI 0 kept (Q6); differs from AT and OP strings
        (2017, "annual", "inp", D, "301", "302", "", "500", 4),
        # rendering equal to org, dropped
        (2017, "annual", "inp", D, "301", "302", "500", "500", 5),
        # text id -> NULL -> dropped
        (2017, "annual", "inp", D, "UNKNOWN", "x", "y", "500", 6),
    ])
    edges = E.medicare_edges_by_role(E.medicare_events(E.medicare_claim_grain(claims)))
    got = rows_of(edges, "role", "physician_npi", "claims")
    assert ("attending", 0, 1) not in got
    assert ("attending", 300, 1) in got and ("attending", 301, 2) in got
    assert ("operating", 200, 1) in got and ("operating", 400, 1) in got and ("operating", 302, 2) in got
    assert all(not (r == "operating" and n == 300) for r, n, _ in got)
    assert ("rendering", 0, 2) in got  # '' from rows 3 and 4
    assert all(not (r == "rendering" and n == 500) for r, n, _ in got)


def test_trailing_blanks_are_ignored(spark, cfg):
    claims = medicare(spark, [
        (2017, "annual", "inp", D, "500 ", "", None, "500", 1),  # self-affiliation but for the padding
        (2017, "annual", "inp", D, "100  ", "100", None, "500 ", 2),  # operating equals attending
        (2017, "annual", "inp", D, "100", "100 ", None, "500", 2),  # the same claim
    ])
    edges = E.medicare_edges_by_role(E.medicare_events(E.medicare_claim_grain(claims)))
    assert rows_of(edges.filter("physician_npi <> 0"), "role", "physician_npi", "org_npi", "claims") == [("attending", 100, 500, 1)]


def test_vintage_is_hidden_key_q4(spark, cfg):
    claims = medicare(spark, [
        (2016, "annual", "inp", date(2017, 1, 5), "100", "", None, "500", 1),
        (2017, "annual", "inp", date(2017, 1, 6), "100", "", None, "500", 2),
    ])
    edges = E.medicare_edges(claims, avail(spark, [(2016, "annual"), (2017, "annual")]), cfg, "attending")
    assert edges.count() == 2  # same (npi, org, month) twice


def test_one_scan_events_equal_per_type_union(spark, cfg):
    """OP-04 equivalence: one dedup keyed by claim type == DISTINCT per type + UNION ALL."""
    from conftest import SF0001
    from provgraph.sources.adapter import load_testdata

    src = load_testdata(spark, SF0001)
    claims = E.medicare_claim_grain(E.selected_claims(src.medicare_claims, src.medicare_availability, cfg.__class__.for_testdata()))
    one_scan = E.medicare_events(claims)
    per_type = None
    for t in ["inp", "out", "snf", "hha", "hosp"]:
        for role in E.MEDICARE_ROLES:
            branch = E.medicare_events(claims.filter(F.col("claim_type") == t), (role,))
            per_type = branch if per_type is None else per_type.unionAll(branch)
    assert one_scan.count() == per_type.count()
    assert one_scan.exceptAll(per_type).count() == 0
