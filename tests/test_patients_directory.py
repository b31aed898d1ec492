from datetime import date

from conftest import commercial, crosswalk, frame, medicare, rows_of
from provgraph.operators import directory, patients
from provgraph.sources import schemas as S

XW = [(11, 1011, None), (21, 1021, 5), (31, 1031, 6), (41, 1041, None)]


def test_unique_patients_commercial_q10_q11(spark, cfg):
    claims = commercial(spark, [
        (2016, 20160101, 11, 21, 31, 1),  # billing -> 5, facility -> 6
        (2016, 20160201, 11, 21, 31, 1),  # same patient again
        (2016, 20160201, 11, 21, None, None),  # NULL patient counts once (Q11)
        (2016, 20160201, 11, None, 31, 2),  # no billing id: lost (Q10)
        (2016, 20160201, 11, 41, None, 3),  # company NULL: dropped
    ])
    out = patients.unique_patients_commercial(claims, crosswalk(spark, XW), cfg)
    assert rows_of(out, "physician_npi", "company_id", "patients_comm") == [(1011, 5, 2), (1011, 6, 1)]


def test_unique_patients_medicare_q12_q13(spark, cfg):
    d = date(2017, 3, 4)
    claims = medicare(spark, [
        (2017, "annual", "inp", d, "100", "", None, "1021", 1),
        (2017, "annual", "out", d, "100", "100", None, "1021", 1),  # same patient, counted once
        (2017, "annual", "inp", d, "100", "", None, "1021", None),  # NULL patient ignored (Q11)
        (2017, "annual", "inp", d, "100", "", None, "1041", 2),  # NULL company -> 0 (Q13)
        (2017, "annual", "inp", d, "100", "", None, "01021", 3),  # not the canonical string: no match
        (2016, "annual", "inp", d, "100", "", None, "1021", 4),  # vintage not selected
        (2017, "annual", "inp", d, "100 ", "", None, "1021  ", 1),  # padded ids: the same keys
    ])
    avail = frame(spark, S.MEDICARE_AVAILABILITY, [(2017, "annual", d)])
    out = patients.unique_patients_medicare(claims, avail, crosswalk(spark, XW), cfg)
    got = rows_of(out, "physician_npi", "company_id", "patients_mcr")
    # '' (blank operating) and NULL (rendering) physicians stay as keys (Q12)
    assert ("100", 5, 1) in got and ("100", 0, 1) in got
    assert ("", 5, 1) in got and (None, 5, 1) in got
    assert all(n <= 1 for _, _, n in got)


def test_crosswalk_zero_filled(spark):
    out = patients.crosswalk_zero_filled(crosswalk(spark, XW))
    assert rows_of(out, "npi", "company_id") == [(1011, 0), (1021, 5), (1031, 6), (1041, 0)]


COMPANIES = [(1, "A", "Hospital", "x", "y"), (2, "B", "Physician Group", "x", "y"), (3, "C", "Imaging Center", "x", "y"),
             (4, "D", "Ambulatory Surgery Center", "x", "y")]


def test_hospital_affiliations_ranks_and_distinct(spark):
    phys = frame(spark, S.DIRECTORY_PHYSICIANS, [(7, 1, 2, None, 99, 1), (7, 1, 2, None, 99, 1)])
    out = directory.hospital_affiliations(phys, frame(spark, S.COMPANIES, COMPANIES), date(2020, 1, 1))
    # id 99 is unknown (inner join), duplicate directory rows collapse (UNION)
    assert rows_of(out, "npi", "hospital_id", "affiliation_rank") == [(7, 1, 1), (7, 1, 5), (7, 2, 2)]


def test_group_and_child_site_affiliations_are_bags(spark):
    phys = frame(spark, S.DIRECTORY_PHYSICIANS, [(7, 1, None, None, None, None), (8, 1, None, None, None, None)])
    links = frame(spark, S.GROUP_PRACTICE, [(7, 2), (7, 2), (8, 5)])
    groups = frame(spark, S.PHYSICIAN_GROUPS, [(2,)])
    asc = frame(spark, S.CHILD_SITES, [(4, 2)])
    comp = frame(spark, S.COMPANIES, COMPANIES)
    g = directory.group_affiliations(links, phys, comp, date(2020, 1, 1))
    assert rows_of(g, "npi", "hospital_id") == [(7, 2), (7, 2)]  # 5 is no company
    c = directory.child_site_affiliations(phys, links, groups, asc, comp, date(2020, 1, 1))
    assert rows_of(c, "npi", "hospital_id", "firm_type") == [(7, 4, "Ambulatory Surgery Center")] * 2
