"""DuckDB SQL of the demographics queries.

Written out by hand: age bands, attributes, codes and codebook rows are stated
here again, so that a wrong constant of the plan does not agree with itself.
"""

from __future__ import annotations

# The attributes in order; ``:text`` marks those that are not coded.
_ATTRIBUTES = """
    age:text agerange agerangedar workinghours relationshiptoheadofhouseholdcode
    relationshiptoheadofhouseholdcode_af_20180101 internetusagehome internetusagework
    ladyofhouseoccupationcode numberoftvsets:text householdincomeamount:text visitorstatuscode zerotv
    educationranges agegenderbuildingblockcode num_of_years_spent_in_the_usa:text numberoftvsetswithpay
    numberoftvsetswithwiredcable numberoftvsetswithwiredcableandpay numberofvcrs
    headofhouseholdhispanicspecificethnicityeffectivejune282010 numberofcars broadcastonly
""".split()

# Code and sequence.
_CODES = [pair.split("=") for pair in """
    agerange_19=1 agerange_20=2 agerange_21=3 agerange_22=4 agerange_23=5 agerange_2=6 agerange_3=7 agerange_4=8
    agerange_5=9 agerange_6=10 agerange_7=11 agerange_8=12 agerange_9=13 agerange_10=14 agerange_11=15
    agerange_12=16 agerange_13=17 agerange_14=18 agerange_15=19 agerange_16=20 agerange_17=21 agerange_18=22
    agerange_2-5=0 agerangedar_1=1 agerangedar_2=2 agerangedar_3=3 agerangedar_4=4 agerangedar_5=5
    agerangedar_6=6 agerangedar_7=7 agerangedar_8=8 agerangedar_9=9 agerangedar_10=10 agerangedar_11=11
    workinghours_0=1 workinghours_1=2 workinghours_2=3 workinghours_3=4 workinghours_4=5 workinghours_5=6
    workinghours_9999=99 relationshiptoheadofhouseholdcode_A=1 relationshiptoheadofhouseholdcode_N=2
    relationshiptoheadofhouseholdcode_R=3 relationshiptoheadofhouseholdcode_9999=99
    relationshiptoheadofhouseholdcode_af_20180101_A=1 relationshiptoheadofhouseholdcode_af_20180101_N=2
    relationshiptoheadofhouseholdcode_af_20180101_R=3 internetusagehome_0=1 internetusagehome_1=2
    internetusagehome_2=3 internetusagehome_3=4 internetusagehome_4=5 internetusagework_9999=99
    ladyofhouseoccupationcode_1=1 ladyofhouseoccupationcode_2=2 ladyofhouseoccupationcode_3=3
    ladyofhouseoccupationcode_4=4 ladyofhouseoccupationcode_5=5 visitorstatuscode_9999=0 zerotv_0=1 zerotv_1=2
    educationranges_F=1 educationranges_O=2 agegenderbuildingblockcode_9999=0 numberoftvsetswithpay_0=1
    numberoftvsetswithpay_1=2 numberoftvsetswithpay_2=3 numberoftvsetswithwiredcable_0=1
    numberoftvsetswithwiredcable_1=2 numberoftvsetswithwiredcableandpay_0=1 numberofvcrs_9999=99
    headofhouseholdhispanicspecificethnicityeffectivejune282010_F=1
    headofhouseholdhispanicspecificethnicityeffectivejune282010_O=2 numberofcars_0=1 numberofcars_1=2
    numberofcars_2=3 broadcastonly_true=1 broadcastonly_false=2 educationranges_7=7 educationranges_9999=99
""".split()]

# Key, name, column, value code, value name.
_CODEBOOK = """
  ('age', 'Age', 1, '2', '2'),
  ('age', 'Age', 1, '17', '17'),
  ('age', 'Age', 1, '18', '18'),
  ('agerange', 'Age range', 2, '19', '2-5'),
  ('agerange', 'Age range', 2, '20', '6-8'),
  ('agerange', 'Age range', 2, '21', '9-11'),
  ('agerange', 'Age range', 2, '22', '12-14'),
  ('agerange', 'Age range', 2, '23', '15-17'),
  ('agerange', 'Age range', 2, '2', '18'),
  ('agerange', 'Age range', 2, '3', '19'),
  ('agerange', 'Age range', 2, '4', '20'),
  ('agerange', 'Age range', 2, '5', '21'),
  ('agerange', 'Age range', 2, '6', '22-24'),
  ('agerange', 'Age range', 2, '7', '25-29'),
  ('agerange', 'Age range', 2, '8', '30-34'),
  ('agerange', 'Age range', 2, '9', '35-39'),
  ('agerange', 'Age range', 2, '10', '40-44'),
  ('agerange', 'Age range', 2, '11', '45-49'),
  ('agerange', 'Age range', 2, '12', '50-54'),
  ('agerange', 'Age range', 2, '13', '55-59'),
  ('agerange', 'Age range', 2, '14', '60-64'),
  ('agerange', 'Age range', 2, '15', '65-69'),
  ('agerange', 'Age range', 2, '16', '70-74'),
  ('agerange', 'Age range', 2, '17', '75-85'),
  ('agerange', 'Age range', 2, '18', '86+'),
  ('agerange', 'Age range', 2, '2-5', 'legacy "2-5" band'),
  ('agerangedar', 'Age range DAR', 3, '1', '2-17'),
  ('agerangedar', 'Age range DAR', 3, '2', '18-20'),
  ('agerangedar', 'Age range DAR', 3, '3', '21-24'),
  ('agerangedar', 'Age range DAR', 3, '4', '25-29'),
  ('agerangedar', 'Age range DAR', 3, '5', '30-34'),
  ('agerangedar', 'Age range DAR', 3, '6', '35-39'),
  ('agerangedar', 'Age range DAR', 3, '7', '40-44'),
  ('agerangedar', 'Age range DAR', 3, '8', '45-49'),
  ('agerangedar', 'Age range DAR', 3, '9', '50-54'),
  ('agerangedar', 'Age range DAR', 3, '10', '55-64'),
  ('agerangedar', 'Age range DAR', 3, '11', '65+'),
  ('workinghours', 'Working hours', 4, '0', 'None'),
  ('workinghours', 'Working hours', 4, '1', '1-10'),
  ('workinghours', 'Working hours', 4, '2', '11-20'),
  ('workinghours', 'Working hours', 4, '3', '21-30'),
  ('workinghours', 'Working hours', 4, '4', '31-40'),
  ('workinghours', 'Working hours', 4, '5', '41+'),
  ('workinghours', 'Working hours', 4, '9999', 'Not available'),
  ('relationshiptoheadofhouseholdcode', 'Relationship to head of household', 5, 'A', 'Head'),
  ('relationshiptoheadofhouseholdcode', 'Relationship to head of household', 5, 'N', 'Spouse'),
  ('relationshiptoheadofhouseholdcode', 'Relationship to head of household', 5, 'R', 'Child'),
  ('relationshiptoheadofhouseholdcode', 'Relationship to head of household', 5, '9999', 'Not available'),
  ('relationshiptoheadofhouseholdcode_af_20180101', 'Relationship to head of household from era date', 6, 'A', 'Head'),
  ('relationshiptoheadofhouseholdcode_af_20180101', 'Relationship to head of household from era date', 6, 'N', 'Spouse'),
  ('relationshiptoheadofhouseholdcode_af_20180101', 'Relationship to head of household from era date', 6, 'R', 'Child'),
  ('internetusagehome', 'Internet usage at home', 7, '0', 'Never'),
  ('internetusagehome', 'Internet usage at home', 7, '1', 'Rarely'),
  ('internetusagehome', 'Internet usage at home', 7, '2', 'Monthly'),
  ('internetusagehome', 'Internet usage at home', 7, '3', 'Weekly'),
  ('internetusagehome', 'Internet usage at home', 7, '4', 'Daily'),
  ('internetusagework', 'Internet usage at work', 8, '9999', 'Not available'),
  ('ladyofhouseoccupationcode', 'Lady of house occupation', 9, '1', 'Professional'),
  ('ladyofhouseoccupationcode', 'Lady of house occupation', 9, '2', 'Clerical'),
  ('ladyofhouseoccupationcode', 'Lady of house occupation', 9, '3', 'Trade'),
  ('ladyofhouseoccupationcode', 'Lady of house occupation', 9, '4', 'Service'),
  ('ladyofhouseoccupationcode', 'Lady of house occupation', 9, '5', 'Not employed'),
  ('numberoftvsets', 'Number of TV sets', 10, NULL, NULL),
  ('householdincomeamount', 'Household income amount', 11, NULL, NULL),
  ('visitorstatuscode', 'Visitor status', 12, '9999', 'Not available'),
  ('zerotv', 'Zero TV household', 13, '0', 'No'),
  ('zerotv', 'Zero TV household', 13, '1', 'Yes'),
  ('educationranges', 'Education ranges', 14, 'F', 'Finished'),
  ('educationranges', 'Education ranges', 14, 'O', 'Ongoing'),
  ('educationranges', 'Education ranges', 14, '007', 'Legacy code'),
  ('educationranges', 'Education ranges', 14, '9999', 'Not available'),
  ('agegenderbuildingblockcode', 'Age and gender building block', 15, '9999', 'Not available'),
  ('num_of_years_spent_in_the_usa', 'Years spent in the USA', 16, NULL, NULL),
  ('numberoftvsetswithpay', 'Number of TV sets with pay', 17, '0', 'None'),
  ('numberoftvsetswithpay', 'Number of TV sets with pay', 17, '1', 'One'),
  ('numberoftvsetswithpay', 'Number of TV sets with pay', 17, '2', 'Two'),
  ('numberoftvsetswithwiredcable', 'Number of TV sets with wired cable', 18, '0', 'None'),
  ('numberoftvsetswithwiredcable', 'Number of TV sets with wired cable', 18, '1', 'One'),
  ('numberoftvsetswithwiredcableandpay', 'Number of TV sets with wired cable and pay', 19, '0', 'None'),
  ('numberofvcrs', 'Number of VCRs', 20, '9999', 'Not available'),
  ('headofhouseholdhispanicspecificethnicityeffectivejune282010', 'Head of household ethnicity', 21, 'F', 'Group F'),
  ('headofhouseholdhispanicspecificethnicityeffectivejune282010', 'Head of household ethnicity', 21, 'O', 'Group O'),
  ('numberofcars', 'Number of cars', 22, '0', 'None'),
  ('numberofcars', 'Number of cars', 22, '1', 'One'),
  ('numberofcars', 'Number of cars', 22, '2', 'Two'),
  ('broadcastonly', 'Broadcast only', 23, 'true', 'Yes'),
  ('broadcastonly', 'Broadcast only', 23, 'false', 'No')"""

_FINE = """CASE WHEN a BETWEEN 2 AND 5 THEN 19 WHEN a BETWEEN 6 AND 8 THEN 20 WHEN a BETWEEN 9 AND 11 THEN 21
  WHEN a BETWEEN 12 AND 14 THEN 22 WHEN a BETWEEN 15 AND 17 THEN 23 WHEN a = 18 THEN 2 WHEN a = 19 THEN 3
  WHEN a = 20 THEN 4 WHEN a = 21 THEN 5 WHEN a BETWEEN 22 AND 24 THEN 6 WHEN a BETWEEN 25 AND 29 THEN 7
  WHEN a BETWEEN 30 AND 34 THEN 8 WHEN a BETWEEN 35 AND 39 THEN 9 WHEN a BETWEEN 40 AND 44 THEN 10
  WHEN a BETWEEN 45 AND 49 THEN 11 WHEN a BETWEEN 50 AND 54 THEN 12 WHEN a BETWEEN 55 AND 59 THEN 13
  WHEN a BETWEEN 60 AND 64 THEN 14 WHEN a BETWEEN 65 AND 69 THEN 15 WHEN a BETWEEN 70 AND 74 THEN 16
  WHEN a BETWEEN 75 AND 85 THEN 17 WHEN a > 85 THEN 18 END"""
_COARSE = """CASE WHEN a BETWEEN 2 AND 17 THEN 1 WHEN a BETWEEN 18 AND 20 THEN 2 WHEN a BETWEEN 21 AND 24 THEN 3
  WHEN a BETWEEN 25 AND 29 THEN 4 WHEN a BETWEEN 30 AND 34 THEN 5 WHEN a BETWEEN 35 AND 39 THEN 6
  WHEN a BETWEEN 40 AND 44 THEN 7 WHEN a BETWEEN 45 AND 49 THEN 8 WHEN a BETWEEN 50 AND 54 THEN 9
  WHEN a BETWEEN 55 AND 64 THEN 10 WHEN a > 64 THEN 11 END"""


def _int(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return (f"(CASE WHEN regexp_full_match({s}, '\\s*[+-]?[0-9]*[.]?[0-9]*\\s*') "
            f"THEN TRY_CAST(trunc(TRY_CAST(trim({s}) AS DECIMAL(38,18))) AS INTEGER) END)")


def _encoded(attribute: str) -> str:
    key, _, plain = attribute.partition(":")
    s = f"CAST({key} AS VARCHAR)"
    return s if plain else (
        f"CASE WHEN {key} IS NULL OR trim({s}) = '' THEN '{key}_9999' "
        f"WHEN regexp_matches({s}, '[0-9]') THEN concat_ws('_', '{key}', CAST({_int(key)} AS VARCHAR)) "
        f"ELSE '{key}_' || {s} END")


_LIST = ", ".join(a.split(":")[0] for a in _ATTRIBUTES)
_TIES = ", ".join(a.split(":")[0] + " DESC NULLS LAST" for a in _ATTRIBUTES)
_AGE = """CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN '999' WHEN l_orderkey % 37 = 0 THEN 'unknown'
              WHEN l_orderkey % 41 = 0 THEN ' ' WHEN l_orderkey % 43 = 0 THEN '2-5'
              ELSE CAST(CAST(l_quantity * 2 - l_orderkey % 2 AS INTEGER) AS VARCHAR) END"""

_BASE = f"""
WITH lo AS (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
person AS (
  SELECT o_custkey AS household_id, l_linenumber AS person_id,
         CAST(l_shipdate AS DATE) AS p_start, CAST(l_shipdate AS DATE) + 60 AS p_end, {_AGE} AS p_age,
         CASE WHEN l_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS p_hours,
         l_returnflag AS p_relation, CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS p_home,
         l_linestatus AS p_work, CAST(year(CAST(l_shipdate AS DATE)) - 1990 AS VARCHAR) AS p_years,
         CASE l_orderkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN '2-5' WHEN 2 THEN '007' WHEN 3 THEN NULL ELSE l_linestatus END AS p_education
  FROM lo),
weights AS (SELECT o_custkey * 10 + l_linenumber AS tv_respondent_id, l_shipdate AS date FROM lo),
respondent AS (
  SELECT c_custkey AS household_id, CAST(r.pid AS INTEGER) AS person_id, c_custkey * 10 + r.pid AS tv_respondent_id,
         CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS t_zero
  FROM customer CROSS JOIN range(1, 8) r(pid)),
h0 AS (
  SELECT o_custkey AS household_id, CAST(o_orderdate AS DATE) AS h_start, o_orderpriority, o_totalprice, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
  FROM orders),
household AS (
  SELECT *, coalesce(lead(h_start) OVER (PARTITION BY household_id ORDER BY h_start), DATE '9999-12-31') - 1 AS h_end
  FROM h0 WHERE rn = 1),
pairs AS (
  SELECT t.*, p.* EXCLUDE (household_id, person_id), h.* EXCLUDE (household_id),
         greatest(h_start, p_start) AS start_date, least(h_end, p_end) AS end_date, {_int('p_age')} AS a
  FROM respondent t JOIN person p USING (household_id, person_id)
  JOIN household h ON p.household_id = h.household_id AND h_start <= p_end AND h_end >= p_start),
cand AS (
  SELECT tv_respondent_id, start_date, end_date,
         CASE WHEN p_age = '999' THEN NULL ELSE p_age END AS age, {_FINE} AS agerange, {_COARSE} AS agerangedar,
         9999 AS agegenderbuildingblockcode, 9999 AS visitorstatuscode, {_int('p_hours')} AS workinghours,
         CASE WHEN start_date < DATE '1999-01-01' THEN p_relation END AS relationshiptoheadofhouseholdcode,
         CASE WHEN start_date >= DATE '1999-01-01' THEN p_relation END AS relationshiptoheadofhouseholdcode_af_20180101,
         {_int('p_home')} AS internetusagehome, {_int('p_work')} AS internetusagework,
         p_years AS num_of_years_spent_in_the_usa, CAST(o_orderpriority[1] AS INTEGER) AS ladyofhouseoccupationcode,
         CAST(floor(o_totalprice / 100000) AS INTEGER) AS numberoftvsets,
         CAST(floor(o_totalprice / 200000) AS INTEGER) AS numberoftvsetswithpay,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS numberoftvsetswithwiredcable,
         0 AS numberoftvsetswithwiredcableandpay, CAST(NULL AS INTEGER) AS numberofvcrs,
         o_orderstatus AS headofhouseholdhispanicspecificethnicityeffectivejune282010,
         CAST(floor(o_totalprice / 150000) AS INTEGER) AS numberofcars,
         CAST(floor(o_totalprice) AS INTEGER) AS householdincomeamount, o_orderstatus = 'P' AS broadcastonly,
         t_zero AS zerotv, p_education AS educationranges
  FROM pairs),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY tv_respondent_id, start_date ORDER BY end_date DESC, {_TIES}) AS rn FROM cand)
  WHERE rn = 1),
closed AS (
  SELECT tv_respondent_id, start_date,
         coalesce(lead(start_date) OVER (PARTITION BY tv_respondent_id ORDER BY start_date), DATE '9999-12-31') - 1 AS end_date,
         {_LIST}
  FROM dedup),
encoded AS (SELECT tv_respondent_id, start_date, end_date, list_value({", ".join(map(_encoded, _ATTRIBUTES))}) AS vals FROM closed),
md AS (SELECT tv_respondent_id, CAST(max(date) AS DATE) AS date FROM weights GROUP BY tv_respondent_id),
win AS (
  SELECT r.tv_respondent_id,
         CASE WHEN DATE '1997-01-01' BETWEEN r.start_date AND r.end_date THEN DATE '1997-01-01' ELSE r.start_date END AS start_date,
         CASE WHEN md.date BETWEEN r.start_date AND r.end_date THEN md.date ELSE r.end_date END AS end_date, r.vals
  FROM md JOIN encoded r ON md.tv_respondent_id = r.tv_respondent_id)"""

_SEQUENCE = "(CASE x " + " ".join(f"WHEN '{code}' THEN '{seq}'" for code, seq in _CODES) + " ELSE x END)"


def _text(vals: str) -> str:
    return f"array_to_string(list_transform({vals}, lambda x: coalesce(x, 'null')), ',')"


ORACLE = {
    "age_buckets": f"""
WITH p AS (SELECT o_custkey AS household_id, l_linenumber AS person_id, CAST(l_shipdate AS DATE) AS start_date, {_AGE} AS age
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
b AS (SELECT *, {_int('age')} AS a FROM p)
SELECT household_id, person_id, start_date, age, {_FINE} AS agerange, {_COARSE} AS agerangedar FROM b""",
    "household_segments": _BASE + """
SELECT household_id, h_start AS start_date, h_end AS end_date, o_orderpriority[1] AS ladyofhouseoccupationcode,
       CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS householdincomeamount FROM household""",
    "interval_overlap_join": _BASE + """
SELECT tv_respondent_id, household_id, person_id, p_start AS p_start_date, h_start AS h_start_date, start_date, end_date
FROM pairs""",
    "dedupe_latest": _BASE + "\nSELECT tv_respondent_id, start_date, end_date FROM dedup",
    "segments_closed": _BASE + "\nSELECT tv_respondent_id, start_date, end_date FROM closed",
    "encode_attribute_values": _BASE + f"""
SELECT tv_respondent_id, start_date, end_date, {_text('vals')} AS values_text FROM encoded""",
    "last_weight_date": """
SELECT o_custkey * 10 + l_linenumber AS tv_respondent_id, CAST(max(l_shipdate) AS DATE) AS date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "demographic_segments": _BASE + f"""
SELECT tv_respondent_id, start_date, end_date, {_text(f"list_transform(vals, lambda x: {_SEQUENCE})")} AS values_text
FROM win WHERE end_date >= DATE '1997-01-01'""",
    "codebook_in_use": _BASE + f""",
book(k, name, pos, code, value) AS (VALUES {_CODEBOOK}),
scoped AS (
  SELECT *, CASE
      WHEN k IN ('agegenderbuildingblockcode', 'visitorstatuscode', 'workinghours', 'relationshiptoheadofhouseholdcode',
                 'educationranges', 'internetusagehome', 'internetusagework', 'numberofvcrs', 'ladyofhouseoccupationcode',
                 'householdincomeamount')
        OR (k = 'agerange' AND value IN ('2-5', '6-8', '9-11', '12-14', '15-17')) OR (k = 'agerangedar' AND value = '2-17')
        OR (k = 'age' AND TRY_CAST(code AS INTEGER) < 18) OR lower(value) = 'not available'
      THEN '<scope panel="TV" universe="*" subUniverses="*"/>' ELSE '*' END AS scope,
    CASE WHEN k IN ('agegenderbuildingblockcode', 'visitorstatuscode', 'workinghours', 'relationshiptoheadofhouseholdcode',
                    'relationshiptoheadofhouseholdcode_af_20180101', 'internetusagehome', 'internetusagework',
                    'ladyofhouseoccupationcode', 'householdincomeamount',
                    'headofhouseholdhispanicspecificethnicityeffectivejune282010')
      THEN 'tvu_demo' ELSE 'demo_0' END AS parent_tree_key
  FROM book),
found AS (
  SELECT pos, code, count(*) AS n FROM (SELECT unnest(vals) AS code, generate_subscripts(vals, 1) AS pos FROM encoded) GROUP BY ALL)
SELECT k AS demographic_key, name AS demographic_name, scope, parent_tree_key, count(s.code) AS n_codes, count(f.n) AS n_codes_found,
       CAST(coalesce(sum(f.n), 0) AS BIGINT) AS n_segments
FROM scoped s LEFT JOIN found f
  ON f.pos = s.pos AND f.code = s.k || '_' || coalesce(CAST(TRY_CAST(s.code AS INTEGER) AS VARCHAR), s.code)
GROUP BY k, name, scope, parent_tree_key""",
}
