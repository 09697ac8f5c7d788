"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the DataFrame code, directly from the semantics:
the same role assignment as :mod:`shoal.plans.roles`, expressed as CTEs.
"""

from __future__ import annotations

# Role CTEs (see shoal.plans.roles for the assignment).
LINES = """lines AS (
  SELECT l.l_orderkey AS SampleID,
         CASE WHEN p.p_brand = 'Brand#1' THEN 'UnID' ELSE p.p_brand END AS Taxa,
         CASE WHEN l.l_linenumber = 1 THEN 0.0 ELSE l.l_quantity END AS Length,
         CAST(1 AS DOUBLE) AS Frequency, l.l_linenumber AS linenumber, l.l_discount AS discount,
         l.l_tax AS tax, l.l_extendedprice AS price, l.l_quantity AS quantity,
         l.l_returnflag AS returnflag, l.l_shipdate AS shipdate
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

SAMPLES = """samples AS (
  SELECT o_orderstatus AS Source, o_orderkey AS SampleID, CAST(o_orderdate AS DATE) AS Date,
         CAST(month(o_orderdate) AS INTEGER) AS Survey, o_orderpriority AS Method,
         o_custkey AS custkey, o_totalprice AS totalprice
  FROM orders)"""

CATCH = """catch AS (
  SELECT SampleID, Taxa, CAST(count(*) + count(*) FILTER (WHERE discount >= 0.05) AS DOUBLE) AS Catch
  FROM lines GROUP BY SampleID, Taxa)"""

FISH = """fish AS (
  SELECT s.Source, s.SampleID, ln.Taxa, ln.quantity AS Length,
         CASE WHEN ln.SampleID IS NULL THEN 0.0
              WHEN ln.tax = 0 THEN NULL
              ELSE CAST(ln.linenumber - 1 AS DOUBLE) END AS Count,
         ln.returnflag AS Notes_catch
  FROM samples s LEFT JOIN lines ln ON s.SampleID = ln.SampleID)"""


DATASET = """sv AS (
  SELECT o.o_orderstatus AS Source, n.n_name AS Station,
         37.0::DOUBLE + n.n_nationkey * 0.09::DOUBLE AS Latitude,
         -123.0::DOUBLE + n.n_regionkey * 0.45::DOUBLE AS Longitude,
         CAST(o.o_orderdate AS DATE) AS Date, CAST(month(o.o_orderdate) AS INTEGER) AS Survey,
         o.o_orderkey AS SampleID, o.o_orderpriority AS Method,
         CASE CAST(month(o.o_orderdate) AS INTEGER) WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb'
              WHEN 3 THEN 'Low Slack' WHEN 4 THEN 'Flood' END AS Tide,
         abs(c.c_acctbal) / 300.0::DOUBLE AS Sal_surf, abs(c.c_acctbal) / 400.0::DOUBLE AS Temp_surf,
         o.o_totalprice / 100 AS Tow_volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
ds0 AS (
  SELECT sv.*, ex.Taxa, ex.Length, ex.Count,
         CASE WHEN ex.Length IS NULL AND ex.Count IS NULL THEN 'No fish caught'
              WHEN ex.Length IS NULL AND ex.Count > 0 THEN 'Unknown length' END AS Length_NA_flag
  FROM sv LEFT JOIN ex ON sv.SampleID = ex.SampleID),
dataset AS (
  SELECT Source, Station, Latitude, Longitude, Date, Survey, SampleID, Method, Tide, Sal_surf,
         Temp_surf, Tow_volume, Taxa, Length,
         CASE WHEN Length_NA_flag = 'No fish caught' THEN 0.0 ELSE Count END AS Count, Length_NA_flag
  FROM ds0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["zero_fill"] = with_(LINES, SAMPLES, FISH, """fd AS (SELECT DISTINCT * FROM fish),
s AS (SELECT DISTINCT Source, SampleID FROM fd),
t AS (SELECT DISTINCT Source, Taxa FROM fd),
grid AS (SELECT s.Source, s.SampleID, t.Taxa FROM s JOIN t ON s.Source = t.Source),
filled AS (
  SELECT g.SampleID, g.Taxa, f.Length, COALESCE(f.Count, 0.0) AS Count, f.Notes_catch
  FROM grid g LEFT JOIN fd f
    ON f.Source = g.Source AND f.SampleID = g.SampleID AND f.Taxa IS NOT DISTINCT FROM g.Taxa)""") + """
SELECT SampleID, Taxa, Length, Count, Notes_catch FROM filled
WHERE Taxa IS NOT NULL AND NOT (Taxa = 'UnID' AND Count = 0)"""

# -- expansion family -------------------------------------------------------------

EXPAND = """measured AS (
  SELECT SampleID, Taxa, Length, sum(Frequency) AS Frequency FROM lines
  WHERE Length <> 0 GROUP BY SampleID, Taxa, Length),
tot AS (SELECT SampleID, Taxa, sum(Frequency) AS TotalMeasured FROM measured GROUP BY SampleID, Taxa),
mt AS (SELECT m.*, t.TotalMeasured FROM measured m JOIN tot t
       ON m.SampleID = t.SampleID AND m.Taxa IS NOT DISTINCT FROM t.Taxa),
ex AS (
  SELECT * FROM (
    SELECT c.SampleID, c.Taxa, mt.Length,
           CASE WHEN mt.Length IS NULL THEN c.Catch
                ELSE mt.Frequency / mt.TotalMeasured * c.Catch END AS Count
    FROM catch c LEFT JOIN mt ON c.SampleID = mt.SampleID AND c.Taxa IS NOT DISTINCT FROM mt.Taxa)
  WHERE Count IS NOT NULL)"""

SQL["expand_counts"] = with_(LINES, CATCH, EXPAND) + """
SELECT SampleID, Taxa, Length, round(Count, 6) AS Count FROM ex"""

SQL["expand_overflow"] = with_(LINES, """measured AS (
  SELECT SampleID, Taxa, Length, CAST(count(*) AS DOUBLE) AS LengthFrequency
  FROM lines WHERE Length <> 0 GROUP BY SampleID, Taxa, Length),
tot AS (SELECT SampleID, Taxa, sum(LengthFrequency) AS TM FROM measured GROUP BY SampleID, Taxa),
c2 AS (SELECT SampleID, Taxa, CAST(count(*) FILTER (WHERE discount >= 0.05) AS DOUBLE) AS Catch
       FROM lines GROUP BY SampleID, Taxa),
j AS (SELECT c.SampleID, c.Taxa, c.Catch, m.Length, m.LengthFrequency, COALESCE(t.TM, 0.0) AS TM
      FROM c2 c LEFT JOIN measured m ON c.SampleID = m.SampleID AND c.Taxa = m.Taxa
      LEFT JOIN tot t ON c.SampleID = t.SampleID AND c.Taxa = t.Taxa),
k AS (SELECT *, CASE WHEN TM > Catch THEN TM ELSE Catch END AS CatchNew FROM j),
e AS (SELECT *, LengthFrequency / NULLIF(TM, 0) * CatchNew AS ex FROM k)""") + """
SELECT SampleID, Taxa, Length,
       round(CASE WHEN Catch IS NOT NULL AND ex IS NULL THEN Catch ELSE ex END, 6) AS Count,
       CatchNew,
       CASE WHEN Catch IS NOT NULL AND ex IS NULL THEN 'Unknown length' END AS Length_NA_flag
FROM e"""

SQL["plus_count_group"] = with_(LINES, """r AS (SELECT SampleID, Taxa, returnflag AS Grp, Length,
       round(tax * 100) AS Count FROM lines),
m AS (SELECT SampleID, Taxa, Grp, Length,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
      FROM r GROUP BY SampleID, Taxa, Grp, Length),
g AS (SELECT SampleID, Taxa, Grp,
             CASE WHEN count(*) FILTER (WHERE Length <> 0) = count(Count) FILTER (WHERE Length <> 0)
                  THEN COALESCE(sum(Count) FILTER (WHERE Length <> 0), 0.0) END AS measured,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS total
      FROM m GROUP BY SampleID, Taxa, Grp),
j AS (SELECT m.*, g.measured, g.total, COALESCE(g.measured = 0 AND m.Count > 0, false) AS inf
      FROM m JOIN g ON m.SampleID = g.SampleID AND m.Taxa = g.Taxa AND m.Grp = g.Grp),
k AS (SELECT *, CASE WHEN inf AND Length = 0 THEN NULL ELSE Length END AS L2 FROM j)""") + """
SELECT SampleID, Taxa, Grp, L2 AS Length,
       round(CASE WHEN inf THEN total ELSE Count / NULLIF(measured, 0) * total END, 6) AS Count,
       CASE WHEN inf THEN 'Unknown length' WHEN L2 IS NULL THEN 'No fish caught' END AS Length_NA_flag
FROM k WHERE L2 <> 0 OR L2 IS NULL"""

SQL["size_group_expand"] = with_(LINES, """r AS (SELECT SampleID, Taxa, Length, quantity,
       CASE WHEN discount >= 0.05 THEN 2.0 ELSE 1.0 END AS Count FROM lines),
rng AS (SELECT SampleID, Taxa, quantity AS mx, Count,
              CAST(row_number() OVER (PARTITION BY SampleID, Taxa ORDER BY quantity, Count) + 1 AS INTEGER) AS g
       FROM r WHERE Length = 0),
grp AS (
  SELECT SampleID, Taxa, 0.0 AS Length, CAST(Count AS DOUBLE) AS Count, g AS SizeGroup FROM rng
  UNION ALL
  SELECT r.SampleID, r.Taxa, r.Length, CAST(r.Count AS DOUBLE) AS Count,
         COALESCE((SELECT min(g.g) FROM rng g WHERE g.SampleID = r.SampleID AND g.Taxa = r.Taxa
                   AND r.Length < g.mx), 1) AS SizeGroup
  FROM r WHERE r.Length <> 0),
tm AS (SELECT SampleID, Taxa, SizeGroup, sum(Count) AS TM FROM grp
       WHERE Length <> 0 OR Length IS NULL GROUP BY SampleID, Taxa, SizeGroup),
tc AS (SELECT SampleID, Taxa, SizeGroup, sum(Count) AS TC FROM grp GROUP BY SampleID, Taxa, SizeGroup),
j AS (SELECT grp.*, tm.TM, tc.TC FROM grp
      LEFT JOIN tm ON grp.SampleID = tm.SampleID AND grp.Taxa = tm.Taxa AND grp.SizeGroup = tm.SizeGroup
      LEFT JOIN tc ON grp.SampleID = tc.SampleID AND grp.Taxa = tc.Taxa AND grp.SizeGroup = tc.SizeGroup)""") + """
SELECT SampleID, Taxa, SizeGroup, CASE WHEN TM IS NULL THEN NULL ELSE Length END AS Length,
       round(CASE WHEN TM IS NULL OR TM = 0 THEN Count ELSE Count / TM * TC END, 6) AS Count,
       CASE WHEN TM IS NULL THEN 'Unknown length' END AS Length_NA_flag
FROM j WHERE Length <> 0 OR Length IS NULL OR TM IS NULL"""

SQL["time_expand"] = with_(LINES, CATCH, """ms AS (SELECT SampleID, Taxa,
       CAST(count(*) FILTER (WHERE Length <> 0) AS DOUBLE) AS TM FROM lines GROUP BY SampleID, Taxa),
r AS (SELECT l.SampleID, l.Taxa, l.Length, c.Catch AS Count, ms.TM,
             CASE WHEN l.Length <> 0 THEN 1.0 END AS LF, l.quantity AS MP,
             CASE WHEN l.tax = 0 THEN 0.0 ELSE 10.0 END AS STL,
             CASE l.returnflag WHEN 'A' THEN '0000' WHEN 'N' THEN '9999' ELSE '8888' END AS Study,
             l.discount > 0 AS FishCaught, l.linenumber AS OrganismCode
      FROM lines l JOIN catch c ON l.SampleID = c.SampleID AND l.Taxa = c.Taxa
      JOIN ms ON l.SampleID = ms.SampleID AND l.Taxa = ms.Taxa),
a AS (SELECT *, CASE WHEN TM IS NOT NULL AND (COALESCE(TM > Count, false) OR Count IS NULL)
                     THEN TM ELSE Count END AS Count1 FROM r),
b AS (SELECT *, CASE WHEN TM IS NOT NULL AND TM <> 0 AND COALESCE(Count1 >= TM, false)
                     THEN LF / TM * Count1 ELSE Count1 END AS Ex FROM a)""") + """
SELECT SampleID, Taxa, Length, round(Count1, 6) AS Count1, round(Ex, 6) AS ExpandedCount,
       round(CASE WHEN (MP IS NULL OR MP = 0 OR STL = 0 OR STL IS NULL)
                       AND COALESCE(FishCaught <> true, false) THEN 0.0
                  WHEN Study = '0000' THEN Ex * (MP / NULLIF(STL, 0))
                  WHEN Study = '9999' THEN Ex
                  WHEN Study = '8888' THEN 0.0
                  ELSE 0.0 END, 6) AS Count
FROM b"""

SQL["volumetric_expand"] = with_(LINES, """ln AS (SELECT SampleID, Taxa, Length, Frequency
       FROM lines WHERE Length <> 0),
cc AS (SELECT SampleID, Taxa,
              CASE WHEN min(discount) = 0 THEN NULL
                   ELSE CAST(count(*) FILTER (WHERE Length = 0) AS DOUBLE) END AS PlusCount,
              sum(quantity) AS QtsCaught,
              sum(CASE WHEN Length = 0 THEN 0.0 ELSE quantity END) AS QtsSubsampled
       FROM lines GROUP BY SampleID, Taxa),
tot AS (SELECT SampleID, Taxa, sum(Frequency) AS TM FROM ln GROUP BY SampleID, Taxa),
tc AS (SELECT cc.SampleID, cc.Taxa, tot.TM,
              (tot.TM + cc.PlusCount) * (cc.QtsCaught / NULLIF(cc.QtsSubsampled, 0)) AS TotalCatch
       FROM cc JOIN tot ON cc.SampleID = tot.SampleID AND cc.Taxa = tot.Taxa
       WHERE cc.PlusCount IS NOT NULL AND tot.TM IS NOT NULL)""") + """
SELECT ln.SampleID, ln.Taxa, ln.Length, ln.Frequency,
       round(ln.Frequency / tc.TM * tc.TotalCatch, 6) AS Count
FROM ln LEFT JOIN tc ON ln.SampleID = tc.SampleID AND ln.Taxa = tc.Taxa"""

SQL["merge_duplicates"] = with_(LINES, SAMPLES, FISH) + """
SELECT Source, SampleID, Taxa, Length,
       round(CASE WHEN count(*) = count(Count) THEN sum(Count) END, 6) AS Count
FROM fish GROUP BY Source, SampleID, Taxa, Length"""

SQL["no_catch_retention"] = with_(LINES, SAMPLES, CATCH, EXPAND, """j AS (
  SELECT s.SampleID, s.Source, ex.Taxa, ex.Length, ex.Count,
         CASE WHEN ex.Length IS NULL AND ex.Count IS NULL THEN 'No fish caught'
              WHEN ex.Length IS NULL AND ex.Count > 0 THEN 'Unknown length' END AS Length_NA_flag
  FROM samples s LEFT JOIN ex ON s.SampleID = ex.SampleID)""") + """
SELECT SampleID, Source, Taxa, Length,
       round(CASE WHEN Length_NA_flag = 'No fish caught' THEN 0.0 ELSE Count END, 6) AS Count,
       Length_NA_flag
FROM j"""

SQL["null_safe_lookup"] = """WITH li AS (
  SELECT l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS code FROM lineitem),
codes AS (SELECT DISTINCT code, COALESCE('flag ' || code, 'missing') AS label FROM li)
SELECT li.code, codes.label, p.p_brand AS Taxa, count(*) AS n
FROM li LEFT JOIN part p ON li.l_partkey = p.p_partkey
LEFT JOIN codes ON li.code IS NOT DISTINCT FROM codes.code
GROUP BY li.code, codes.label, p.p_brand"""

SQL["full_outer_chain"] = with_(LINES, SAMPLES, """a AS (SELECT CASE WHEN Source = 'P' THEN -SampleID ELSE SampleID END AS SampleID, Source FROM samples),
b AS (SELECT SampleID, CASE WHEN linenumber > 4 THEN -linenumber ELSE linenumber END AS Tow, quantity FROM lines),
c AS (SELECT SampleID, CASE WHEN discount < 0.03 THEN linenumber + 100 ELSE linenumber END AS Tow, Taxa, price FROM lines),
ab AS (SELECT COALESCE(a.SampleID, b.SampleID) AS SampleID, a.Source, b.Tow, b.quantity
       FROM a FULL JOIN b ON a.SampleID = b.SampleID)""") + """
SELECT COALESCE(ab.SampleID, c.SampleID) AS SampleID, ab.Source, COALESCE(ab.Tow, c.Tow) AS Tow,
       ab.quantity, c.Taxa, c.price
FROM ab FULL JOIN c ON ab.SampleID IS NOT DISTINCT FROM c.SampleID AND ab.Tow IS NOT DISTINCT FROM c.Tow"""

SQL["calibration_fallback"] = """WITH corr AS (
  SELECT CAST(year(l.l_shipdate) + CASE WHEN s.s_nationkey % 2 = 0 THEN 20 ELSE 0 END AS INTEGER) AS Year,
         s.s_nationkey AS Serial, avg(l.l_discount) AS kFactor
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2),
cd AS (SELECT DISTINCT Year, Serial, kFactor FROM corr),
avgk AS (SELECT Serial, avg(kFactor) AS kavg FROM cd GROUP BY Serial),
tows AS (SELECT o.o_orderkey AS SampleID, CAST(year(o.o_orderdate) AS INTEGER) AS Year,
                c.c_nationkey AS Serial, o.o_totalprice / 1000 AS MeterCheck
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT t.SampleID, round(COALESCE(cd.kFactor, a.kavg), 6) AS kFactor_final,
       round(t.MeterCheck * COALESCE(cd.kFactor, a.kavg) * 1.51, 6) AS Tow_volume
FROM tows t LEFT JOIN cd ON t.Year = cd.Year AND t.Serial = cd.Serial
LEFT JOIN avgk a ON t.Serial = a.Serial"""

# -- filters ----------------------------------------------------------------------

_NO_SAMPLING = "|".join([
    r"no\s*(count|cnt|fish\s*(count|cnt|salvage))",
    r"(shut\s*down|shutdown|facilityshutdown)",
    r"down\s*for\s*(maintenance|repairs)",
    r"no\s*(pumping|water|flow|salvage|export|TFF.*salvage)",
    r"(zero|0)\s*(count|slvg|export|flow|pumping|salvage|units|bapp)",
    r"(power\s*outage|equipment\s*failure)",
    r"stopped\s*pumping\s*water",
    r"no\s+(fish\s+|10\s+(min(ute)?\.?\s+)?)?(count)",
])
_NOTE_HITS = r"licen[cs]e|@|\d{3}-\d{4}"

_DOCS = """WITH ds AS (
  SELECT d.doc_id AS SampleID, d.text AS Notes_tow, CAST(l.quality AS DOUBLE) AS Count,
         CASE WHEN d.lang = 'en' THEN 'Normal count' ELSE 'Second flush' END AS Method
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT SampleID, Count, Method FROM ds
WHERE NOT COALESCE(COALESCE(regexp_matches(Notes_tow, '{p}', 'i'), false)
                   AND Count = 0 AND Method = 'Normal count', false)"""

SQL["notes_regex"] = _DOCS.format(p=_NO_SAMPLING)
SQL["notes_regex_hits"] = _DOCS.format(p=_NOTE_HITS)

SQL["drop_spurious_no_fish"] = with_(LINES, """r AS (SELECT SampleID, Taxa, Length,
       CAST(linenumber - 1 AS DOUBLE) AS Count FROM lines),
v AS (SELECT SampleID, COALESCE(sum(Count), 0.0) AS valid FROM r GROUP BY SampleID)""") + """
SELECT r.SampleID, r.Taxa, r.Length, r.Count FROM r JOIN v ON r.SampleID = v.SampleID
WHERE NOT (v.valid > 0 AND COALESCE(r.Taxa = 'UnID', false))"""

SQL["drop_totals"] = """WITH r AS (
  SELECT l_orderkey AS SampleID, l_linenumber AS OrganismCode, l_quantity AS quantity FROM lineitem),
ps AS (SELECT SampleID, count(*) AS n, max(CASE WHEN OrganismCode = 5 THEN 1 ELSE 0 END) AS x
       FROM (SELECT DISTINCT SampleID, OrganismCode FROM r) t GROUP BY SampleID),
fl AS (SELECT SampleID FROM ps WHERE n <> 1 OR x = 1)
SELECT SampleID, OrganismCode, quantity FROM r WHERE OrganismCode NOT IN (5, 6, 7)
UNION ALL
SELECT SampleID, OrganismCode, quantity FROM r
WHERE OrganismCode IN (6, 7) AND SampleID NOT IN (SELECT SampleID FROM fl)"""

SQL["exclusion_windows"] = """WITH s AS (
  SELECT o.o_orderkey AS SampleID, o.o_orderstatus AS Source, n.n_name AS Station,
         CAST(o.o_orderdate AS DATE) AS Date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
w AS (SELECT Station, min(Date) AS st, min(Date) + 30 AS en FROM s GROUP BY Station
      UNION ALL SELECT Station, max(Date), max(Date) FROM s GROUP BY Station)
SELECT SampleID, Source, Station, Date FROM s
WHERE NOT (Source = 'F' AND EXISTS (SELECT 1 FROM w WHERE w.Station = s.Station
                                    AND s.Date BETWEEN w.st AND w.en))"""

SQL["patch_table"] = """WITH p AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 AS q2 FROM lineitem WHERE l_discount = 0.1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, COALESCE(p.q2, l.l_quantity) AS l_quantity
FROM lineitem l LEFT JOIN p ON l.l_orderkey = p.l_orderkey AND l.l_linenumber = p.l_linenumber
                            AND l.l_partkey = p.l_partkey"""

SQL["partial_lengths"] = with_(LINES, """r AS (SELECT SampleID, Taxa, Length,
       CASE WHEN Length = 0 THEN NULL ELSE 1.0::DOUBLE END AS LF, discount > 0.02 AS FishCaught,
       CAST(SampleID AS VARCHAR) || ' ' || Taxa AS k FROM lines),
per AS (SELECT k, count(*) FILTER (WHERE LF IS NULL OR LF = 0) AS nas FROM r GROUP BY k),
j AS (SELECT r.*, CASE WHEN r.k IS NOT NULL AND COALESCE(r.FishCaught = true, false)
                       THEN per.nas ELSE 0 END AS nas
      FROM r LEFT JOIN per ON r.k = per.k)""") + """
SELECT SampleID, Taxa, Length, LF AS LengthFrequency FROM j
WHERE NOT (nas = 1 AND (LF IS NULL OR LF = 0))"""

# -- row-level derivations ----------------------------------------------------------

SQL["salinity"] = """WITH b AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 2 * 0.001::DOUBLE AS C FROM lineitem),
k AS (SELECT 25.0::DOUBLE AS t),
c AS (SELECT b.*, C / 42.914::DOUBLE /
         (0.6766097::DOUBLE + 0.0200564::DOUBLE * t + 0.0001104259::DOUBLE * t * t
          + (-6.9698e-7)::DOUBLE * t * t * t + 1.0031e-9::DOUBLE * t * t * t * t) AS Rt,
         (t - 15.0::DOUBLE) / (1.0::DOUBLE + 0.0162::DOUBLE * (t - 15.0::DOUBLE)) AS f
      FROM b, k),
s AS (SELECT *, 0.0080::DOUBLE + (-0.1692)::DOUBLE * sqrt(Rt) + 25.3851::DOUBLE * Rt
          + 14.0941::DOUBLE * (Rt * sqrt(Rt)) + (-7.0261)::DOUBLE * (Rt * Rt)
          + 2.7081::DOUBLE * (Rt * Rt * sqrt(Rt))
          + f * (0.0005::DOUBLE + (-0.0056)::DOUBLE * sqrt(Rt) + (-0.0066)::DOUBLE * Rt
                 + (-0.0375)::DOUBLE * (Rt * sqrt(Rt)) + 0.0636::DOUBLE * (Rt * Rt)
                 + (-0.0144)::DOUBLE * (Rt * Rt * sqrt(Rt))) AS S0
      FROM c),
h AS (SELECT *, CASE WHEN C IS NULL OR C < 0 THEN NULL
                     WHEN S0 < 2 THEN S0 - 0.0080::DOUBLE / (1.0::DOUBLE + 1.5::DOUBLE * (400.0::DOUBLE * Rt)
                                          + (400.0::DOUBLE * Rt) * (400.0::DOUBLE * Rt))
                                   - 0.0005::DOUBLE * f / (1.0::DOUBLE + sqrt(100.0::DOUBLE * Rt)
                                          + 100.0::DOUBLE * Rt + (100.0::DOUBLE * Rt) * sqrt(100.0::DOUBLE * Rt))
                     ELSE S0 END AS sal
      FROM s)
SELECT l_orderkey, l_linenumber, round(sal, 6) AS Sal_surf,
       round(CASE WHEN sal < 0 AND sal > -0.1 THEN 0.0 WHEN sal > 40 THEN NULL ELSE sal END, 6) AS Sal_clamped
FROM h"""

SQL["dms_units"] = """SELECT c.c_custkey AS custkey,
  round((37 + n.n_regionkey) + c.c_nationkey / 60.0::DOUBLE + abs(c.c_acctbal) / 200 / 3600.0::DOUBLE, 6) AS Latitude,
  round(-(121 + c.c_nationkey / 60.0::DOUBLE + abs(c.c_acctbal) / 200 / 3600.0::DOUBLE), 6) AS Longitude,
  round(c.c_acctbal * 0.3048::DOUBLE, 6) AS Depth,
  round((c.c_acctbal - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE, 6) AS Temp_surf,
  round(c.c_acctbal * 100.0::DOUBLE, 6) AS Secchi,
  round(c.c_acctbal * 1233.48::DOUBLE, 6) AS Tow_volume,
  round(c.c_acctbal * 1852.0::DOUBLE, 6) AS Distance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

SQL["meter_effort"] = """WITH b AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_tax, l_extendedprice,
         l_quantity * 1000 - l_extendedprice AS d0 FROM lineitem),
c AS (SELECT *, CASE WHEN d0 < 0 THEN d0 + 1000000.0::DOUBLE ELSE d0 END AS d FROM b),
v AS (SELECT *, d * 0.026873027::DOUBLE * 13.95::DOUBLE AS vol,
             CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice END AS st,
             CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS debris FROM c),
e AS (SELECT *, CASE WHEN debris IS NULL THEN vol WHEN debris IN ('Y', 'Yes') THEN NULL ELSE vol END AS inv
      FROM v)
SELECT l_orderkey, l_linenumber, round(d, 6) AS Meter_total, round(vol, 6) AS Tow_volume,
       round(CASE WHEN l_linenumber = 7 THEN 735.0::DOUBLE
                  ELSE COALESCE(CASE WHEN st IS NULL THEN 735.0::DOUBLE ELSE vol END, 735.0::DOUBLE) END, 6)
         AS Tow_volume_default,
       round(CASE WHEN inv = 0 THEN NULL ELSE inv END, 6) AS Tow_volume_valid
FROM e"""

SQL["compose_datetime"] = """WITH b AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d,
         CAST(l_quantity AS INTEGER) % 24 AS h, (l_linenumber - 1) * 7 AS m FROM lineitem),
c AS (SELECT *, CASE WHEN h = 0 AND m = 0 THEN NULL
                     ELSE make_timestamp(year(d), month(d), day(d), h, m, 0) END AS dt FROM b),
g AS (SELECT *, COALESCE(timezone('America/Los_Angeles', timezone('America/Los_Angeles', dt)) <> dt, false)
                AS gap FROM c),
f AS (SELECT *, CASE WHEN gap AND hour(dt) = 2 AND minute(dt) = 0 AND second(dt) = 0
                     THEN dt + INTERVAL 1 HOUR WHEN gap THEN NULL ELSE dt END AS fx FROM g)
SELECT l_orderkey, l_linenumber, strftime(dt, '%Y-%m-%d %H:%M:%S') AS Datetime,
       strftime(fx, '%Y-%m-%d %H:%M:%S') AS Datetime_fixed,
       CAST(year(fx) AS INTEGER) AS year, CAST(month(fx) AS INTEGER) AS month,
       CAST(hour(fx) AS INTEGER) AS hour, CAST(minute(fx) AS INTEGER) AS minute
FROM f"""

SQL["codes_labels"] = r"""WITH p AS (
  SELECT *, CASE WHEN stage IS NOT NULL THEN p_name || ' (' || stage || ')' ELSE p_name END AS label
  FROM (SELECT *, CASE WHEN p_size < 10 THEN 'Age-0' WHEN p_size < 20 THEN 'Juvenile' END AS stage
        FROM part) t)
SELECT p_partkey,
  CASE p_size WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack' WHEN 4 THEN 'Flood' END AS Tide,
  CASE WHEN p_size IN (1, 2, 51, 54, 55, 56, 57) THEN 'Valid'
       WHEN p_size IN (0, 52, 53, 58) THEN 'Invalid' END AS Tow_status,
  CASE WHEN regexp_matches(p_type, '^ECO') THEN 'Economy'
       WHEN regexp_matches(p_type, '^(SMALL|MEDIUM)') THEN 'Sized' END AS Class,
  label AS Taxa_label, regexp_replace(label, ' \(.*$', '') AS Taxa,
  lpad(CAST(p_size AS VARCHAR), 3, '0') AS Station, upper(p_name) AS Name_upper
FROM p"""

SQL["sample_ids"] = """WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_custkey,
         CASE WHEN starts_with(o_orderpriority, '5') THEN NULL ELSE o_orderpriority END AS priority,
         CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY o_orderdate, o_orderkey) AS n
      FROM o)
SELECT o_orderkey,
       concat_ws(' ', o_orderstatus, CAST(o_orderkey AS VARCHAR), COALESCE(priority, 'NA')) AS SampleID,
       concat_ws(' ', CAST(o_custkey AS VARCHAR), CAST(yr AS VARCHAR), CAST(n AS VARCHAR)) AS NumberedID
FROM n"""

SQL["facility_station"] = r"""WITH o AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS method,
         CASE WHEN starts_with(o_orderpriority, '1') THEN NULL ELSE substring(o_orderpriority, 3, 20) END AS location,
         CASE WHEN starts_with(o_orderpriority, '2') THEN 'SWP' END AS fallback
  FROM orders),
f AS (SELECT o_orderkey, concat_ws(' ', CASE WHEN method = 1 THEN 'SWP' WHEN method = 2 THEN 'CVP'
                                             WHEN method IS NULL AND fallback IS NOT NULL THEN fallback ELSE 'NA' END,
                                   COALESCE(location, 'NA')) AS st0 FROM o),
g AS (SELECT o_orderkey, CASE WHEN st0 = 'CVP NA' THEN 'CVP Federal Facility' ELSE st0 END AS Station FROM f)
SELECT o_orderkey, Station,
       NULLIF(regexp_extract(Station, '\b(CVP|SWP)\b', 1), '') AS Facility FROM g"""

SQL["size_comments"] = r"""WITH d AS (SELECT doc_id, text,
  CASE WHEN instr(text, 'age 0') > 0 THEN 'Age-0' WHEN instr(text, 'age 1') > 0 THEN 'Age-1'
       WHEN instr(text, 'age 2') > 0 THEN 'Age-2+' END AS age,
  CASE WHEN instr(text, 'YOY') > 0 THEN 'YOY' WHEN instr(text, 'larva') > 0 THEN 'Larval'
       WHEN instr(text, 'uvenile') > 0 THEN 'Juvenile' WHEN instr(text, 'dult') > 0 THEN 'Adult' END AS stage,
  regexp_extract(text, '(\d+(\.\d+)?)', 1) AS num
  FROM documents)
SELECT doc_id, COALESCE(instr(text, '>') > 0, false) AS min_length,
       COALESCE(instr(text, '~') > 0, false) OR COALESCE(instr(text, 'about') > 0, false) AS approx_length,
       COALESCE(instr(text, '<') > 0, false) AS max_length,
       CASE WHEN num = '' THEN NULL ELSE TRY_CAST(num AS DOUBLE) END AS number,
       COALESCE(age, stage) AS lifestage,
       COALESCE(instr(text, 'egg') > 0, false) OR COALESCE(instr(text, 'ovi') > 0, false)
         OR COALESCE(instr(text, 'OVI') > 0, false) AS ignore
FROM d"""

# -- integrate, slice, summaries ----------------------------------------------------

DS = with_(LINES, SAMPLES, CATCH, EXPAND, DATASET)
FISH_T = "ft AS (SELECT DISTINCT Source, SampleID, Taxa, Length, Count FROM dataset)"
WEB = """web AS (SELECT s.Date, s.Source, l.Taxa, sum(l.quantity) / 10 AS Salvage_web
        FROM lines l JOIN (SELECT * REPLACE (CASE WHEN Source = 'P' THEN 'Pending' ELSE Source END AS Source) FROM samples) s
          ON l.SampleID = s.SampleID
        GROUP BY s.Date, s.Source, l.Taxa)"""


def ds_with(*ctes: str) -> str:
    return DS.rstrip("\n") + (",\n" + ",\n".join(ctes) if ctes else "") + "\n"


SQL["normalise_survey"] = ds_with() + """
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude, floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, Survey,
       SampleID, Method, Tide, floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume
FROM (SELECT DISTINCT Source, Station, Latitude, Longitude, Date, Survey, SampleID, Method, Tide,
                      Sal_surf, Temp_surf, Tow_volume FROM dataset) t"""

SQL["normalise_fish"] = ds_with(FISH_T) + """
SELECT Source, SampleID, Taxa, Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count FROM ft"""

SQL["measured_lengths"] = ds_with("kept AS (SELECT DISTINCT CASE WHEN Source = 'P' THEN -SampleID ELSE SampleID END AS SampleID FROM dataset)") + r"""
SELECT SampleID, regexp_replace(Taxa, ' \(.*$', '') AS Taxa, Length,
       CASE WHEN count(*) = count(Frequency) THEN sum(Frequency) END AS Count
FROM lines WHERE Length <> 0 AND SampleID IN (SELECT SampleID FROM kept)
GROUP BY SampleID, regexp_replace(Taxa, ' \(.*$', ''), Length"""

SQL["slice_aggregate"] = ds_with(FISH_T, """s AS (SELECT DISTINCT Source, SampleID, Date FROM dataset
       WHERE Source IN ('F', 'O') AND month(Date) IN (1, 2, 3, 4, 5, 6) AND year(Date) BETWEEN 1996 AND 2000),
fj AS (SELECT ft.SampleID, ft.Taxa, ft.Length, ft.Count, s.Source AS src FROM ft JOIN s ON ft.SampleID = s.SampleID),
fw AS (SELECT * FROM fj WHERE Length IS NULL OR
         (Length >= CASE WHEN src = 'O' THEN 10.0 ELSE 5.0 END AND Length <= CASE WHEN src = 'O' THEN 40.0 ELSE 45.0 END)),
fa AS (SELECT SampleID, Taxa, COALESCE(sum(Count), 0.0) AS Count FROM fw GROUP BY SampleID, Taxa)""") + """
SELECT s.SampleID, s.Source, s.Date, fa.Taxa, round(fa.Count, 6) AS Count
FROM s LEFT JOIN fa ON s.SampleID = fa.SampleID"""

SQL["yearly_catch"] = ds_with() + """
SELECT CAST(year(Date) AS INTEGER) AS Year, Taxa, round(COALESCE(sum(Count), 0.0), 6) AS Count
FROM dataset GROUP BY 1, 2"""

SQL["taxon_totals"] = ds_with(FISH_T) + """
SELECT Taxa, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count FROM (
  SELECT Taxa, COALESCE(sum(Count), 0.0) AS Count FROM ft GROUP BY Taxa) t WHERE Count > 0"""

SQL["length_window"] = ds_with(FISH_T) + """
SELECT Source, SampleID, Taxa, Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count FROM ft
WHERE (Length IS NULL OR (Length >= CASE Source WHEN 'F' THEN 10.0 WHEN 'O' THEN 20.0 ELSE 0.0 END
                          AND Length <= CASE Source WHEN 'F' THEN 30.0 WHEN 'O' THEN 45.0 ELSE 50.0 END))
  AND (Length IS NULL OR Length >= 3.0)"""

SQL["convert_length"] = ds_with("""eq AS (SELECT Taxa AS Species, avg(tax) * 10 AS Intercept,
       1 + avg(discount) AS Slope FROM lines GROUP BY Taxa)""") + """
SELECT d.Source, d.SampleID, d.Taxa,
       round(CASE WHEN d.Source IN ('O') AND eq.Slope IS NOT NULL THEN eq.Intercept + eq.Slope * d.Length
                  ELSE d.Length END, 6) AS Length
FROM dataset d LEFT JOIN eq ON d.Taxa IS NOT DISTINCT FROM eq.Species"""

SQL["coverage"] = ds_with() + """
SELECT round(min(Latitude), 6) AS south, round(max(Latitude), 6) AS north, round(min(Longitude), 6) AS west,
       round(max(Longitude), 6) AS east, min(Date) AS "begin", max(Date) AS "end" FROM dataset"""

SQL["profile"] = ds_with() + """
SELECT Source, count(*) AS rows, count(*) FILTER (WHERE Count = 0) AS zero_counts,
       count(*) FILTER (WHERE Length > 0) AS positive_lengths,
       count(*) FILTER (WHERE Length IS NULL) AS null_lengths,
       count(DISTINCT SampleID) AS samples, count(DISTINCT Taxa) AS taxa,
       COALESCE(string_agg(DISTINCT Taxa, ',' ORDER BY Taxa), '') AS taxa_list
FROM dataset GROUP BY Source"""

SQL["dimensions"] = ds_with(FISH_T) + """
SELECT DISTINCT 'source' AS dimension, Source AS value FROM dataset
UNION ALL SELECT DISTINCT 'taxon', Taxa FROM ft WHERE Taxa IS NOT NULL
UNION ALL SELECT 'year_min', CAST(min(year(Date)) AS VARCHAR) FROM dataset
UNION ALL SELECT 'year_max', CAST(max(year(Date)) AS VARCHAR) FROM dataset
UNION ALL SELECT 'length_max', CAST(max(CASE WHEN Length > 0 THEN Length END) AS VARCHAR) FROM ft"""

SQL["reconcile"] = ds_with(WEB, """ours AS (SELECT Taxa, Source, COALESCE(sum(Count), 0.0) AS Salvage_db
        FROM dataset GROUP BY Taxa, Source),
theirs AS (SELECT Taxa, Source, sum(Salvage_web) AS Salvage_web FROM web GROUP BY Taxa, Source)""") + """
SELECT COALESCE(o.Taxa, t.Taxa) AS Taxa, COALESCE(o.Source, t.Source) AS Source,
       round(o.Salvage_db, 6) AS Salvage_db, round(t.Salvage_web, 6) AS Salvage_web,
       round(o.Salvage_db - t.Salvage_web, 6) AS difference,
       round((o.Salvage_db - t.Salvage_web) / NULLIF(t.Salvage_web, 0), 6) AS prop_difference
FROM ours o FULL JOIN theirs t ON o.Taxa IS NOT DISTINCT FROM t.Taxa AND o.Source IS NOT DISTINCT FROM t.Source"""

SQL["cumulative"] = ds_with(WEB, """ours AS (SELECT Date, Source, sum(Count) AS Salvage_db FROM dataset GROUP BY Date, Source),
th AS (SELECT Date, Source, sum(Salvage_web) AS Salvage_web FROM web GROUP BY Date, Source),
b AS (SELECT COALESCE(o.Date, t.Date) AS Date, COALESCE(o.Source, t.Source) AS Source, o.Salvage_db, t.Salvage_web
      FROM ours o FULL JOIN th t ON o.Date IS NOT DISTINCT FROM t.Date AND o.Source IS NOT DISTINCT FROM t.Source),
lng AS (SELECT Source, Date, 'Salvage_db' AS series, Salvage_db AS value FROM b
        UNION ALL SELECT Source, Date, 'Salvage_web', Salvage_web FROM b),
daily AS (SELECT Source, series, Date, sum(value) AS value FROM lng GROUP BY Source, series, Date)""") + """
SELECT Source, Date, series, floor(value * 1000000.0 + 0.5) / 1000000.0 AS value,
       round(sum(value) OVER (PARTITION BY Source, series ORDER BY Date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumulative
FROM daily"""

SQL["daily_total"] = ds_with() + """
SELECT Date, Source, SampleID, Taxa, Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count,
       round(COALESCE(sum(Count) OVER (PARTITION BY Date, Source), 0.0), 6) AS dailySalvage
FROM dataset"""

SQL["domain_fill"] = ds_with("""o AS (SELECT Date, Source, Taxa, Count FROM dataset),
lv AS (SELECT DISTINCT Taxa FROM lines),
k AS (SELECT DISTINCT Date, Source FROM o),
pres AS (SELECT DISTINCT Date, Source, Taxa FROM o WHERE Taxa IS NOT NULL)""") + """
SELECT Date, Source, Taxa, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count, true AS originalData FROM o
UNION ALL
SELECT k.Date, k.Source, lv.Taxa, 0.0::DOUBLE AS Count, NULL::BOOLEAN AS originalData FROM k CROSS JOIN lv
WHERE NOT EXISTS (SELECT 1 FROM pres p WHERE p.Date = k.Date AND p.Source = k.Source AND p.Taxa = lv.Taxa)"""

_NF = "COALESCE(Length_NA_flag = 'No fish caught', false)"
_UL = "COALESCE(Length_NA_flag = 'Unknown length', false)"
_QUALITY_RULES = [
    ("q1_latitude_box", "Latitude IS NOT NULL AND NOT (Latitude < 39.3 AND Latitude > 37.0)"),
    ("q1_longitude_box", "Longitude IS NOT NULL AND NOT (Longitude < -121.0 AND Longitude > -123.0)"),
    ("q2_date_type", "false"),
    ("q2_date_format", "NOT COALESCE(regexp_matches(CAST(Date AS VARCHAR), '^[0-9]{4}-[0-9]{2}-[0-9]{2}'), false)"),
    ("q3_tide_domain", "Tide IS NOT NULL AND NOT COALESCE(Tide IN ('Low Slack', 'Ebb', 'High Slack', 'Flood'), false)"),
    ("q3_method_domain", "NOT COALESCE(Method IN ('Midwater trawl', 'Otter trawl', 'Kodiak trawl', 'Beach seine', "
                         "'20mm net', 'Oblique tow', 'STN net', 'Normal count', 'Second flush'), false)"),
    ("q3_flag_domain", "Length_NA_flag IS NOT NULL AND NOT COALESCE(Length_NA_flag IN ('No fish caught', 'Unknown length'), false)"),
    ("q4_empty_not_flagged", f"(Length IS NULL AND Count = 0) AND NOT {_NF}"),
    ("q4_flagged_not_empty", f"{_NF} AND NOT COALESCE(Length IS NULL AND Count = 0, false)"),
    ("q4_flagged_with_taxon", f"{_NF} AND Taxa IS NOT NULL"),
    ("q4_null_taxon_not_flagged", f"Taxa IS NULL AND Length_NA_flag IS NOT NULL AND NOT {_NF}"),
    ("q5_unknown_not_flagged", f"Length IS NULL AND Count > 0 AND NOT {_UL}"),
    ("q5_flagged_not_unknown", f"{_UL} AND NOT COALESCE(Length IS NULL AND Count > 0, false)"),
    ("q6_unflagged_missing", "Length_NA_flag IS NULL AND (Count IS NULL OR Taxa IS NULL)"),
    ("q6_count_without_taxon", "Count > 0 AND Taxa IS NULL"),
    ("q7_zero_not_flagged", f"Count = 0 AND NOT {_NF}"),
    ("q7_flagged_not_zero", f"{_NF} AND NOT COALESCE(Count = 0, false)"),
    ("q7_null_count", "Count IS NULL"),
    ("q8_negative_volume", "Tow_volume < 0"),
    ("q8_zero_volume", "Tow_volume = 0 AND Source <> 'Salvage'"),
    ("q10_sal_surf_negative", "Sal_surf < 0"),
    ("q10_sal_surf_high", "Sal_surf > 40"),
    ("q10_temp_negative", "Temp_surf < 0"),
    ("q10_temp_high", "Temp_surf > 40"),
]


def _rule_union(rules, table="dataset"):
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {cond}) AS violations FROM {table}"
        for name, cond in rules)


SQL["quality_report"] = ds_with() + _rule_union(_QUALITY_RULES)

SQL["range_checks"] = ds_with() + _rule_union([
    ("range_Length", "false OR Length < 1.0 OR Length > 45.0"),
    ("range_Survey", "false OR Survey < 1 OR Survey > 6"),
    ("range_Tow_volume", "false OR Tow_volume > 4000.0"),
    ("range_Temp_surf", "false OR Temp_surf < 0.0 OR Temp_surf > 20.0"),
])

SQL["crosswalk_duplicates"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS code_column, CAST({c} AS VARCHAR) AS code, count(*) AS n FROM part "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1" for c in ("p_size", "p_brand", "p_type"))

SQL["unknown_codes"] = """SELECT DISTINCT c_nationkey FROM customer
WHERE c_nationkey IS NOT NULL
  AND c_nationkey NOT IN (SELECT CASE WHEN n_regionkey = 0 THEN n_nationkey + 1000 ELSE n_nationkey END FROM nation)"""

SQL["salmon_loss"] = with_(LINES, SAMPLES, """r AS (
  SELECT l.SampleID, l.linenumber, CASE WHEN s.Source = 'F' THEN 'SWP' ELSE 'CVP' END AS Facility,
         (CASE WHEN l.linenumber >= 1 THEN 21 ELSE 0 END) + (CASE WHEN l.linenumber >= 2 THEN 21 ELSE 0 END)
         + (CASE WHEN l.linenumber >= 3 THEN 43 ELSE 0 END) + (CASE WHEN l.linenumber >= 4 THEN 43 ELSE 0 END)
         + (CASE WHEN l.linenumber >= 5 THEN 21 ELSE 0 END) AS w,
         l.price / 100 AS flow, l.quantity / 10 AS depth, l.quantity * 3 AS Length,
         CAST(l.linenumber AS DOUBLE) AS Count,
         CASE WHEN l.returnflag = 'N' THEN '0000' ELSE '9999' END AS Method
  FROM lines l JOIN samples s ON l.SampleID = s.SampleID),
a AS (SELECT *, CAST(CASE WHEN Facility = 'SWP' THEN w ELSE 84 END AS INTEGER) AS TotalWidth FROM r),
b AS (SELECT *, flow / NULLIF(depth * TotalWidth, 0) AS vel FROM a),
c AS (SELECT *, Count / NULLIF(CASE WHEN Length < 101 THEN 0.630::DOUBLE + 0.0494::DOUBLE * vel
                                     ELSE 0.568::DOUBLE + 0.0579::DOUBLE * vel END, 0) AS Encounter FROM b),
e AS (SELECT *, CASE WHEN Facility = 'SWP' THEN Encounter / 0.25::DOUBLE ELSE Encounter / 0.85::DOUBLE END AS Entrain,
             CASE WHEN Length < 101 THEN Count * 0.98::DOUBLE ELSE Count END AS Release FROM c)""") + """
SELECT SampleID, linenumber, Facility, TotalWidth, floor(Encounter * 1000000.0 + 0.5) / 1000000.0 AS Encounter, floor(Entrain * 1000000.0 + 0.5) / 1000000.0 AS Entrain,
       floor(Release * 1000000.0 + 0.5) / 1000000.0 AS Release,
       round(CASE WHEN Method = '0000' THEN Entrain - Release
                  WHEN Facility = 'SWP' AND Method = '9999' THEN Count * 4.33::DOUBLE
                  WHEN Facility = 'CVP' AND Method = '9999' THEN Count * 0.569::DOUBLE END, 6) AS Loss
FROM e"""

SQL["extract_profile"] = ds_with() + """
SELECT count(*) AS rows, count(*) <= 1048576 AS fits_spreadsheet,
       round(count(*) * (0.00025::DOUBLE * 1048576), 6) AS bytes_estimate FROM dataset"""

SQL["fill_audit"] = with_(LINES, SAMPLES, FISH) + """
SELECT 'before' AS stage, round(sum(Count), 6) AS Count FROM fish WHERE Taxa IS NOT NULL
UNION ALL SELECT 'after', round(sum(COALESCE(Count, 0.0)), 6) FROM fish WHERE Taxa IS NOT NULL"""

SQL["same_set"] = with_(LINES, SAMPLES) + """
SELECT count(*) FILTER (WHERE b.SampleID IS NULL) AS only_left, count(*) FILTER (WHERE a.SampleID IS NULL) AS only_right
FROM (SELECT DISTINCT SampleID FROM samples) a FULL JOIN (SELECT DISTINCT SampleID FROM lines) b
  ON a.SampleID = b.SampleID"""

SQL["first_per_group"] = with_(LINES) + """
SELECT SampleID, linenumber, Taxa, quantity FROM (
  SELECT SampleID, linenumber, Taxa, quantity,
         row_number() OVER (PARTITION BY SampleID ORDER BY linenumber, Taxa, quantity) AS rn FROM lines) t
WHERE rn = 1"""

SQL["count_over"] = with_(LINES) + """
SELECT SampleID, linenumber, Taxa, count(*) OVER (PARTITION BY SampleID) AS n FROM lines"""

SQL["integrity"] = ds_with(FISH_T, """sv2 AS (SELECT DISTINCT Source, Station, Latitude, Longitude, Date, Survey, SampleID,
        Method, Tide, Sal_surf, Temp_surf, Tow_volume FROM dataset),
gs AS (SELECT DISTINCT Source, SampleID FROM ft),
gt AS (SELECT DISTINCT Source, Taxa FROM ft WHERE Taxa IS NOT NULL),
filled AS (
  SELECT g.Source, g.SampleID, g.Taxa, f.Length, COALESCE(f.Count, 0.0) AS Count
  FROM (SELECT gs.Source, gs.SampleID, gt.Taxa FROM gs JOIN gt ON gs.Source = gt.Source) g
  LEFT JOIN ft f ON f.Source = g.Source AND f.SampleID = g.SampleID AND f.Taxa = g.Taxa)""") + """
SELECT 'duplicate_sample_ids' AS "check", count(*) AS value FROM (
  SELECT SampleID FROM sv2 GROUP BY SampleID HAVING count(*) > 1) t
UNION ALL SELECT 'duplicate_fish_keys', count(*) FROM (
  SELECT SampleID, Taxa, Length FROM filled GROUP BY SampleID, Taxa, Length HAVING count(*) > 1) t
UNION ALL SELECT 'samples_lost', count(*) FROM (
  SELECT DISTINCT SampleID FROM sv2 WHERE SampleID NOT IN (SELECT SampleID FROM filled)) t
UNION ALL SELECT 'incomplete_samples', count(*) FROM (
  SELECT s.Source, s.SampleID FROM (SELECT Source, SampleID, count(DISTINCT Taxa) AS tp FROM filled GROUP BY 1, 2) s
  JOIN (SELECT Source, count(DISTINCT Taxa) AS tg FROM filled GROUP BY 1) g ON s.Source = g.Source
  WHERE s.tp <> g.tg) t
UNION ALL SELECT 'rows_removed_by_distinct', (SELECT count(*) FROM ft) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ft) t)"""

SQL["golden_bounds"] = ds_with(FISH_T, """bounds AS (SELECT Taxa, count(*) FILTER (WHERE returnflag = 'R') * 3 AS min_rows,
       sum(quantity) / 20 AS min_sum FROM lines GROUP BY Taxa),
got AS (SELECT Taxa, count(*) AS rows, sum(Count) AS total FROM ft GROUP BY Taxa)""") + """
SELECT b.Taxa, b.min_rows, round(b.min_sum, 6) AS min_sum, g.rows, round(g.total, 6) AS total
FROM bounds b LEFT JOIN got g ON b.Taxa IS NOT DISTINCT FROM g.Taxa
WHERE COALESCE(g.rows, 0) < b.min_rows OR COALESCE(g.total, 0.0) < b.min_sum"""

SQL["measured_exceeds_catch"] = with_(LINES, """measured AS (
  SELECT SampleID, Taxa, Length, CAST(count(*) AS DOUBLE) AS LengthFrequency
  FROM lines WHERE Length <> 0 GROUP BY SampleID, Taxa, Length),
tot AS (SELECT SampleID, Taxa, sum(LengthFrequency) AS TM FROM measured GROUP BY SampleID, Taxa),
c2 AS (SELECT SampleID, Taxa, CAST(count(*) FILTER (WHERE discount >= 0.05) AS DOUBLE) AS Catch
       FROM lines GROUP BY SampleID, Taxa)""") + """
SELECT DISTINCT c.SampleID, c.Taxa, t.TM AS TotalMeasured, c.Catch
FROM c2 c JOIN tot t ON c.SampleID = t.SampleID AND c.Taxa = t.Taxa WHERE t.TM > c.Catch"""

# -- more inventory items ---------------------------------------------------------

SQL["assemble_chain"] = """SELECT o.o_orderstatus AS Source, n.n_name AS Station, o.o_orderkey AS SampleID,
       CAST(NULL AS VARCHAR) AS Method, r.r_name AS Tow_direction
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

SQL["union_split"] = """WITH a AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS Size, p_name, CAST(NULL AS VARCHAR) AS Kind
           FROM part WHERE p_size <= 25),
b AS (SELECT p_partkey, p_size / 2 AS Size, CAST(NULL AS VARCHAR) AS p_name, p_type AS Kind FROM part WHERE p_size > 25),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT p_partkey, Size, Kind, trim(string_split(p_name, ' ')[1]) AS colour,
       trim(string_split(p_name, ' ')[2]) AS thing FROM u"""

SQL["catch_filters"] = with_(LINES, CATCH, """c AS (SELECT SampleID, Taxa, Catch - 1 AS Catch FROM catch WHERE Catch - 1 > 0),
j AS (SELECT c.*, CAST(o.o_orderdate AS DATE) AS Date FROM c LEFT JOIN orders o ON c.SampleID = o.o_orderkey),
j2 AS (SELECT * FROM j WHERE Date IS NOT NULL AND Date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'),
ln AS (SELECT SampleID, Taxa, count(*) AS n_lengths FROM (
         SELECT SampleID, Taxa, CASE WHEN Length = 0 THEN NULL ELSE Length END AS L FROM lines) t
       WHERE L IS NULL OR L >= 25.0 GROUP BY SampleID, Taxa)""") + """
SELECT j2.SampleID, j2.Taxa, j2.Catch, j2.Date, ln.n_lengths
FROM j2 LEFT JOIN ln ON j2.SampleID = ln.SampleID AND j2.Taxa IS NOT DISTINCT FROM ln.Taxa"""

SQL["tow_filters"] = with_(LINES, """r AS (SELECT SampleID, Taxa, linenumber, quantity,
       CASE WHEN returnflag = 'R' THEN NULL ELSE returnflag END AS Method,
       CASE WHEN linenumber IN (1, 2, 51, 54, 55, 56, 57) THEN 'Valid'
            WHEN linenumber IN (0, 52, 53, 58) THEN 'Invalid' END AS Tow_status,
       CASE WHEN tax = 0 THEN NULL ELSE tax END AS tax FROM lines)""") + """
SELECT SampleID, Taxa, linenumber, quantity, Method, Tow_status FROM r
WHERE COALESCE(Method IN ('A', 'N'), false) AND Tow_status = 'Valid' AND tax IS NOT NULL
  AND Taxa IN ('Brand#2', 'Brand#3', 'Brand#5', 'UnID')
  AND NOT (quantity > CASE WHEN Taxa = 'UnID' THEN 10.0 WHEN Taxa = 'Brand#2' THEN 45.0 END)"""

SQL["effort_geometry"] = """SELECT c_custkey,
  round(-122.0::DOUBLE - abs(c_acctbal) / 200 / 60.0::DOUBLE, 6) AS Longitude,
  round(abs(c_acctbal) / 1000 * 1852.0::DOUBLE * 3.42::DOUBLE, 6) AS Tow_area,
  round(c_nationkey / 60.0::DOUBLE * 4000.0::DOUBLE * 4.3::DOUBLE * 0.7::DOUBLE, 6) AS Tow_area_duration,
  CASE WHEN st = 'Adult' AND c_nationkey < 10 THEN 'Age-2+' ELSE st END AS Lifestage,
  round_even(c_acctbal / 3, 2) AS Rounded
FROM (SELECT *, CASE mk WHEN 'YOY' THEN 'Age-0' WHEN 'Larval' THEN 'Age-0' WHEN 'Yearling' THEN 'Age-1' ELSE mk END AS st
      FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'YOY' WHEN 'MACHINERY' THEN 'Adult'
                                        WHEN 'AUTOMOBILE' THEN 'Larval' END AS mk FROM customer) t) u"""

SQL["size_bounds"] = with_(LINES, SAMPLES, """s AS (SELECT SampleID, CAST(month(Date) AS INTEGER) AS Month FROM samples),
com AS (SELECT l.SampleID, l.Taxa, s.Month,
               CASE WHEN l.returnflag = 'A' THEN 'Age-0' ELSE 'Age-1' END AS Lifestage,
               CASE WHEN l.discount > 0.05 THEN l.quantity END AS Min_length, CAST(NULL AS DOUBLE) AS Max_length
        FROM lines l JOIN s ON l.SampleID = s.SampleID WHERE l.Length = 0),
ages AS (SELECT s.Month, l.Taxa, min(l.quantity) AS mn, max(l.quantity) AS mx, 'Age-0' AS Lifestage
         FROM lines l JOIN s ON l.SampleID = s.SampleID GROUP BY s.Month, l.Taxa),
present AS (SELECT SampleID, Taxa FROM lines WHERE linenumber = 2)""") + """
SELECT c.SampleID, c.Taxa, c.Month, c.Lifestage, COALESCE(c.Min_length, a.mn) AS Min_length,
       COALESCE(c.Max_length, a.mx) AS Max_length
FROM com c LEFT JOIN ages a ON c.Lifestage = a.Lifestage AND c.Month = a.Month AND c.Taxa = a.Taxa
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.SampleID = c.SampleID AND p.Taxa = c.Taxa)"""

SQL["sorted_taxa"] = with_(LINES, SAMPLES, FISH) + """
SELECT Source, COALESCE(string_agg(DISTINCT Taxa, ',' ORDER BY Taxa), '') AS taxa FROM fish GROUP BY Source"""

_SAL_CHAIN = """k AS (SELECT 25.0::DOUBLE AS t),
sc AS (SELECT sal_in.*, C / 42.914::DOUBLE /
         (0.6766097::DOUBLE + 0.0200564::DOUBLE * t + 0.0001104259::DOUBLE * t * t
          + (-6.9698e-7)::DOUBLE * t * t * t + 1.0031e-9::DOUBLE * t * t * t * t) AS Rt,
         (t - 15.0::DOUBLE) / (1.0::DOUBLE + 0.0162::DOUBLE * (t - 15.0::DOUBLE)) AS f
      FROM sal_in, k),
ss AS (SELECT *, 0.0080::DOUBLE + (-0.1692)::DOUBLE * sqrt(Rt) + 25.3851::DOUBLE * Rt
          + 14.0941::DOUBLE * (Rt * sqrt(Rt)) + (-7.0261)::DOUBLE * (Rt * Rt)
          + 2.7081::DOUBLE * (Rt * Rt * sqrt(Rt))
          + f * (0.0005::DOUBLE + (-0.0056)::DOUBLE * sqrt(Rt) + (-0.0066)::DOUBLE * Rt
                 + (-0.0375)::DOUBLE * (Rt * sqrt(Rt)) + 0.0636::DOUBLE * (Rt * Rt)
                 + (-0.0144)::DOUBLE * (Rt * Rt * sqrt(Rt))) AS S0
      FROM sc),
sh AS (SELECT *, CASE WHEN C IS NULL OR C < 0 THEN NULL
                     WHEN S0 < 2 THEN S0 - 0.0080::DOUBLE / (1.0::DOUBLE + 1.5::DOUBLE * (400.0::DOUBLE * Rt)
                                          + (400.0::DOUBLE * Rt) * (400.0::DOUBLE * Rt))
                                   - 0.0005::DOUBLE * f / (1.0::DOUBLE + sqrt(100.0::DOUBLE * Rt)
                                          + 100.0::DOUBLE * Rt + (100.0::DOUBLE * Rt) * sqrt(100.0::DOUBLE * Rt))
                     ELSE S0 END AS sal
      FROM ss)"""

SQL["fmwt_job"] = r"""WITH st AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS Station,
         37.0::DOUBLE + n_nationkey * 0.09::DOUBLE AS Latitude,
         -123.0::DOUBLE + n_regionkey * 0.45::DOUBLE AS Longitude FROM nation),
src AS (SELECT o.o_orderkey AS SampleRowID, c.c_nationkey AS StationCode, o.o_orderpriority, o.o_orderstatus,
               o.o_orderdate, o.o_custkey, o.o_totalprice, c.c_acctbal, n.n_regionkey
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
s0 AS (SELECT SampleRowID, lpad(CAST(StationCode AS VARCHAR), 3, '0') AS Station, CAST(o_orderdate AS DATE) AS Date,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE StationCode % 24 END AS h,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 60 END AS m,
              CAST(month(o_orderdate) AS INTEGER) AS Survey,
              abs(c_acctbal) / 400 AS Temp_surf, o_totalprice / 50000 AS TurbidityNTU,
              0.5::DOUBLE * 100.0::DOUBLE AS Secchi, o_orderstatus = 'F' AS Secchi_estimated,
              o_totalprice / 10 AS CT, o_totalprice / 8 AS CB,
              CASE n_regionkey WHEN 1 THEN 'With current' WHEN 2 THEN 'Against current' WHEN 3 THEN 'Unknown' END
                AS Tow_direction,
              CASE WHEN (1000.0::DOUBLE + o_totalprice / 10) - 1000.0::DOUBLE = 0 THEN NULL
                   ELSE ((1000.0::DOUBLE + o_totalprice / 10) - 1000.0::DOUBLE) * 0.02687::DOUBLE * 10.7::DOUBLE
              END AS Tow_volume,
              100.0::DOUBLE * 0.3048::DOUBLE AS Cable_length,
              CASE n_regionkey WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack' WHEN 4 THEN 'Flood' END
                AS Tide,
              c_acctbal / 100 * 0.3048::DOUBLE AS Depth
       FROM src WHERE o_orderpriority <> '5-LOW'),
s1 AS (SELECT *, CASE WHEN h IS NULL OR m IS NULL OR (h = 0 AND m = 0) THEN NULL
                      ELSE make_timestamp(year(Date), month(Date), day(Date), h, m, 0) END AS dt FROM s0),
sal_in AS (SELECT SampleRowID, 'top' AS w, CT * 0.001::DOUBLE AS C FROM s0
           UNION ALL SELECT SampleRowID, 'bot', CB * 0.001::DOUBLE FROM s0),
""" + _SAL_CHAIN + r""",
sal AS (SELECT SampleRowID, max(CASE WHEN w = 'top' THEN sal END) AS Sal_surf,
               max(CASE WHEN w = 'bot' THEN sal END) AS Sal_bot FROM sh GROUP BY SampleRowID),
s AS (SELECT s1.*, st.Latitude, st.Longitude, sal.Sal_surf, sal.Sal_bot
      FROM s1 LEFT JOIN st ON s1.Station = st.Station LEFT JOIN sal ON s1.SampleRowID = sal.SampleRowID),
ln AS (SELECT l.l_orderkey AS SampleID, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS brand_no,
              l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
spt AS (SELECT FMWT_Code, CASE WHEN FMWT_Code <= 3 THEN ScientificName || ' (Age 0)' ELSE ScientificName END AS Taxa
        FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS FMWT_Code,
                              p_brand AS ScientificName FROM part) t),
catch AS (SELECT SampleID AS SampleRowID, brand_no AS OrganismCode,
                 CAST(count(*) + count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Catch
          FROM ln GROUP BY SampleID, brand_no),
ct AS (SELECT c.*, spt.Taxa FROM catch c LEFT JOIN spt ON c.OrganismCode = spt.FMWT_Code),
len AS (SELECT SampleID AS SampleRowID, brand_no AS OrganismCode,
               CASE WHEN l_tax = 0 THEN NULL WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END AS ForkLength,
               1.0::DOUBLE AS LF FROM ln),
meas AS (SELECT SampleRowID, OrganismCode, ForkLength, CASE WHEN count(*) = count(LF) THEN sum(LF) END AS LF
         FROM len WHERE ForkLength <> 0 GROUP BY SampleRowID, OrganismCode, ForkLength),
tot AS (SELECT SampleRowID, OrganismCode, COALESCE(sum(LF), 0.0) AS TM FROM meas GROUP BY SampleRowID, OrganismCode),
mt AS (SELECT meas.*, tot.TM FROM meas JOIN tot ON meas.SampleRowID = tot.SampleRowID
                                         AND meas.OrganismCode = tot.OrganismCode),
cl AS (SELECT * FROM (
         SELECT ct.SampleRowID, ct.Taxa, mt.ForkLength,
                CASE WHEN mt.ForkLength IS NULL THEN ct.Catch ELSE mt.LF / mt.TM * ct.Catch END AS Count
         FROM ct LEFT JOIN mt ON ct.SampleRowID = mt.SampleRowID AND ct.OrganismCode = mt.OrganismCode) t
       WHERE Count IS NOT NULL),
d1 AS (SELECT s.*, cl.Taxa, cl.ForkLength AS Length, cl.Count,
              CASE WHEN cl.ForkLength IS NULL AND cl.Count IS NULL THEN 'No fish caught'
                   WHEN cl.ForkLength IS NULL THEN 'Unknown length' END AS flag
       FROM s LEFT JOIN cl ON s.SampleRowID = cl.SampleRowID),
d2 AS (SELECT 'FMWT' AS Source, Station, Latitude, Longitude, Date, dt AS Datetime, Survey, Depth,
              'FMWT ' || CAST(SampleRowID AS VARCHAR) AS SampleID, 'Midwater trawl' AS Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, Secchi, Secchi_estimated, Tow_volume, Tow_direction, Cable_length,
              regexp_replace(Taxa, ' \(.*$', '') AS Taxa, Length,
              CASE WHEN flag = 'No fish caught' THEN 0.0 ELSE Count END AS Count, flag AS Length_NA_flag FROM d1),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, Secchi, Secchi_estimated, Tow_volume, Tow_direction, Cable_length,
              Taxa, Length, Length_NA_flag, CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude, floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date,
       CAST(Datetime AS VARCHAR) AS Datetime, Survey, floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU, floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, Secchi_estimated,
       floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume, Tow_direction, floor(Cable_length * 1000000.0 + 0.5) / 1000000.0 AS Cable_length, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count, Length_NA_flag
FROM mg"""

SQL["integrate_fish"] = ds_with(FISH_T, """s AS (SELECT DISTINCT Source, SampleID FROM ft),
t AS (SELECT DISTINCT Source, Taxa FROM ft),
grid AS (SELECT s.Source, s.SampleID, t.Taxa FROM s JOIN t ON s.Source = t.Source),
filled AS (
  SELECT g.SampleID, g.Taxa, f.Length, COALESCE(f.Count, 0.0) AS Count
  FROM grid g LEFT JOIN ft f
    ON f.Source = g.Source AND f.SampleID = g.SampleID AND f.Taxa IS NOT DISTINCT FROM g.Taxa)""") + """
SELECT SampleID, Taxa, Length, round(Count, 6) AS Count FROM filled
WHERE Taxa IS NOT NULL AND NOT (Taxa = 'UnID' AND Count = 0)"""

SQL["salvage_job"] = r"""WITH smp AS (
  SELECT o_orderkey AS SampleRowID, o_orderdate AS SampleDate,
         lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST((o_custkey % 6) * 10 AS VARCHAR), 2, '0')
           || ':00.0000000' AS SampleTime,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '9999' WHEN o_orderpriority = '5-LOW' THEN '8888' ELSE '0000' END
           AS StudyRowID,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice / 1000 END AS AcreFeet,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE 60.0::DOUBLE END AS MinutesPumping,
         10.0::DOUBLE + (o_custkey % 3) * 5 AS SampleTimeLength,
         o_totalprice % 80 AS WaterTemperature,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS SampleMethod,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'no count, shut down' END AS Comments_Sample
  FROM orders),
ln AS (SELECT l.l_orderkey AS SampleID, l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag,
              CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS brand_no
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
ln2 AS (SELECT *, SampleID * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BuildingRowID,
               CASE WHEN brand_no = 24 THEN 98 WHEN brand_no = 25 THEN 81 ELSE brand_no END AS OrganismCode FROM ln),
bld AS (SELECT DISTINCT BuildingRowID, SampleID AS SampleRowID,
               CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS BuildingCode, l_returnflag AS Location FROM ln2),
cat AS (SELECT BuildingRowID, OrganismCode,
               CAST(count(*) + count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Count,
               BuildingRowID * 100 + OrganismCode AS CatchRowID
        FROM ln2 GROUP BY BuildingRowID, OrganismCode),
len AS (SELECT BuildingRowID * 100 + OrganismCode AS CatchRowID, l_linenumber AS LengthRowID,
               CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END AS ForkLength,
               CASE WHEN l_tax = 0 THEN NULL ELSE 1.0::DOUBLE END AS LengthFrequency FROM ln2),
xw AS (SELECT DISTINCT Salvage_Code, Taxa FROM (
         SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS Salvage_Code,
                CASE WHEN CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) = 2 THEN p_brand || ' (Age 1)'
                     ELSE p_brand END AS Taxa FROM part) t
       WHERE NOT COALESCE(regexp_matches(Taxa, 'Age'), false)),
j1 AS (SELECT COALESCE(s.SampleRowID, b.SampleRowID) AS SampleRowID, s.SampleDate, s.SampleTime, s.StudyRowID,
              s.AcreFeet, s.MinutesPumping, s.SampleTimeLength, s.WaterTemperature, s.SampleMethod, s.Comments_Sample,
              b.BuildingRowID, b.BuildingCode, b.Location
       FROM smp s FULL JOIN bld b ON s.SampleRowID IS NOT DISTINCT FROM b.SampleRowID),
j2 AS (SELECT j1.* EXCLUDE (BuildingRowID), COALESCE(j1.BuildingRowID, c.BuildingRowID) AS BuildingRowID,
              c.OrganismCode, c.Count, c.CatchRowID
       FROM j1 FULL JOIN cat c ON j1.BuildingRowID IS NOT DISTINCT FROM c.BuildingRowID),
j3 AS (SELECT j2.* EXCLUDE (CatchRowID), COALESCE(j2.CatchRowID, l.CatchRowID) AS CatchRowID,
              l.LengthRowID, l.ForkLength, l.LengthFrequency
       FROM j2 FULL JOIN len l ON j2.CatchRowID IS NOT DISTINCT FROM l.CatchRowID),
j4 AS (SELECT j3.*, CASE j3.StudyRowID WHEN '0000' THEN 'Normal count' WHEN '9999' THEN 'Second flush'
                                        WHEN '8888' THEN 'Special study' END AS Description,
              CASE j3.BuildingCode WHEN 1 THEN 'SWP' WHEN 2 THEN 'CVP' END AS Comments_StationsLookUp
       FROM j3),
j5 AS (SELECT * FROM j4 WHERE COALESCE(Description IN ('Normal count', 'Second flush'), false)),
ps AS (SELECT SampleRowID, count(*) AS n, max(CASE WHEN COALESCE(OrganismCode IN (81), false) THEN 1 ELSE 0 END) AS x
       FROM (SELECT DISTINCT SampleRowID, OrganismCode FROM j5) t GROUP BY SampleRowID),
fl AS (SELECT SampleRowID FROM ps WHERE n <> 1 OR x = 1),
j6 AS (SELECT * FROM j5 WHERE NOT COALESCE(OrganismCode IN (98, 99), false)
       UNION ALL
       SELECT * FROM j5 WHERE COALESCE(OrganismCode IN (98, 99), false)
         AND NOT EXISTS (SELECT 1 FROM fl WHERE fl.SampleRowID IS NOT DISTINCT FROM j5.SampleRowID)),
j7 AS (SELECT * FROM j6 WHERE NOT COALESCE(OrganismCode IN (81), false)),
j8 AS (SELECT *, CASE WHEN st0 = 'CVP NA' THEN 'CVP Federal Facility' ELSE st0 END AS Station FROM (
         SELECT *, concat_ws(' ', CASE WHEN SampleMethod = 1 THEN 'SWP' WHEN SampleMethod = 2 THEN 'CVP'
                                       WHEN SampleMethod IS NULL AND Comments_StationsLookUp IS NOT NULL
                                         THEN Comments_StationsLookUp ELSE 'NA' END,
                             COALESCE(Location, 'NA')) AS st0 FROM j7) t),
j9 AS (SELECT j8.* EXCLUDE (st0), NULLIF(regexp_extract(Station, '\b(CVP|SWP)\b', 1), '') AS Facility FROM j8),
cg AS (SELECT SampleRowID, Station,
              (COALESCE(sum(LengthFrequency), 0) > 0) OR (COALESCE(sum(Count), 0) > 0) AS FishCaught
       FROM j9 GROUP BY SampleRowID, Station),
tmq AS (SELECT CatchRowID, COALESCE(sum(LengthFrequency), 0.0) AS TotalMeasured FROM j9 GROUP BY CatchRowID),
j10 AS (SELECT j9.*, cg.FishCaught, tmq.TotalMeasured, xw.Taxa
        FROM j9 LEFT JOIN cg ON j9.SampleRowID IS NOT DISTINCT FROM cg.SampleRowID
                            AND j9.Station IS NOT DISTINCT FROM cg.Station
        LEFT JOIN tmq ON j9.CatchRowID IS NOT DISTINCT FROM tmq.CatchRowID
        LEFT JOIN xw ON j9.OrganismCode IS NOT DISTINCT FROM xw.Salvage_Code),
j11 AS (SELECT SampleRowID, SampleDate, SampleTime, StudyRowID, AcreFeet, MinutesPumping, SampleTimeLength,
               WaterTemperature, SampleMethod, Comments_Sample, BuildingRowID, BuildingCode, Location, OrganismCode,
               Count, CatchRowID, ForkLength, Description, Comments_StationsLookUp, Station, Facility, FishCaught,
               TotalMeasured, Taxa,
               CASE WHEN count(*) = count(LengthFrequency) THEN sum(LengthFrequency) END AS LengthFrequency
        FROM j10 GROUP BY ALL),
j12 AS (SELECT *, TRY_CAST(concat_ws(' ', CAST(CAST(SampleDate AS DATE) AS VARCHAR), substr(SampleTime, 1, 8))
                           AS TIMESTAMP) AS lt,
               CAST(SampleDate AS DATE) AS Date FROM j11),
j13 AS (SELECT *, COALESCE(timezone('America/Los_Angeles', timezone('America/Los_Angeles', lt)) <> lt, false) AS gap
        FROM j12),
j14 AS (SELECT *,
          CASE WHEN gap AND hour(lt) = 2 AND minute(lt) = 0 AND second(lt) = 0 THEN lt + INTERVAL 1 HOUR
               WHEN gap THEN NULL ELSE lt END AS Datetime,
          AcreFeet * 1233.48::DOUBLE AS Tow_volume,
          CASE WHEN (WaterTemperature - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE < 0 THEN NULL
               ELSE (WaterTemperature - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE END AS Temp_surf,
          CASE WHEN Taxa IS NOT NULL AND FishCaught <> true THEN NULL ELSE Taxa END AS Taxa2,
          CASE WHEN ForkLength = 0 THEN NULL ELSE ForkLength END AS Length
        FROM j13),
e1 AS (SELECT *, CASE WHEN TotalMeasured IS NOT NULL AND (COALESCE(TotalMeasured > Count, false) OR Count IS NULL)
                      THEN TotalMeasured ELSE Count END AS Count1 FROM j14),
e2 AS (SELECT *, CASE WHEN TotalMeasured IS NOT NULL AND TotalMeasured <> 0 AND COALESCE(Count1 >= TotalMeasured, false)
                      THEN LengthFrequency / TotalMeasured * Count1 ELSE Count1 END AS Ex FROM e1),
e3 AS (SELECT *, CASE
          WHEN SampleRowID IN (32, 33, 34, 35) THEN Ex * (MinutesPumping / 20.0::DOUBLE)
          WHEN (MinutesPumping IS NULL OR MinutesPumping = 0 OR SampleTimeLength = 0 OR SampleTimeLength IS NULL)
               AND COALESCE(FishCaught <> true, false) THEN 0.0
          WHEN Station IS NULL AND COALESCE(FishCaught <> true, false) THEN 0.0
          WHEN StudyRowID = '0000' THEN Ex * (MinutesPumping / NULLIF(SampleTimeLength, 0))
          WHEN StudyRowID = '9999' THEN Ex
          WHEN StudyRowID = '8888' THEN 0.0
          WHEN OrganismCode IN (98, 99) THEN 0.0
          ELSE 0.0 END AS Cnt FROM e2),
e4 AS (SELECT *, CASE WHEN COALESCE(FishCaught <> true, false) THEN 'No fish caught'
                      WHEN Length IS NULL AND Cnt > 0 THEN 'Unknown length' END AS flag
       FROM e3 WHERE Date IS NOT NULL),
pl AS (SELECT CatchRowID, count(*) FILTER (WHERE (LengthFrequency IS NULL OR LengthFrequency = 0) AND flag IS NULL) AS nas
       FROM e4 GROUP BY CatchRowID),
e5 AS (SELECT e4.* FROM e4 LEFT JOIN pl ON e4.CatchRowID IS NOT DISTINCT FROM pl.CatchRowID
       WHERE NOT ((CASE WHEN e4.CatchRowID IS NOT NULL AND COALESCE(e4.FishCaught = true, false) THEN pl.nas ELSE 0 END) = 1
                  AND (e4.LengthFrequency IS NULL OR e4.LengthFrequency = 0))),
ids AS (SELECT *, 'Salvage ' || CAST(SampleRowID AS VARCHAR) || ' ' ||
                  CAST(row_number() OVER (PARTITION BY Facility, SampleRowID ORDER BY Location ASC NULLS LAST) AS VARCHAR)
                  AS SampleID
        FROM (SELECT DISTINCT Facility, Location, SampleRowID FROM e5) t),
e6 AS (SELECT DISTINCT 'Salvage' AS Source, e5.Station,
              CASE e5.Comments_StationsLookUp WHEN 'SWP' THEN 37.825612769565474::DOUBLE WHEN 'CVP' THEN 37.81667106195238::DOUBLE END
                AS Latitude,
              CASE e5.Comments_StationsLookUp WHEN 'SWP' THEN -121.59584120116043::DOUBLE WHEN 'CVP' THEN -121.55857777929133::DOUBLE END
                AS Longitude,
              e5.Date, e5.Datetime, ids.SampleID, e5.Description AS Method, e5.Tow_volume, e5.Temp_surf,
              e5.Comments_Sample AS Notes_tow, e5.Taxa2 AS Taxa, e5.Length, e5.Cnt AS Count, e5.flag AS Length_NA_flag
       FROM e5 LEFT JOIN ids ON e5.Facility IS NOT DISTINCT FROM ids.Facility
                            AND e5.Location IS NOT DISTINCT FROM ids.Location
                            AND e5.SampleRowID IS NOT DISTINCT FROM ids.SampleRowID),
e7 AS (SELECT * FROM e6 WHERE NOT COALESCE(COALESCE(regexp_matches(Notes_tow, '""" + _NO_SAMPLING + r"""', 'i'), false)
                                           AND Count = 0 AND Method = 'Normal count', false))
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime,
       SampleID, Method, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf, Notes_tow, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM e7
WHERE NOT COALESCE(Station = 'SWP A' AND Date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND Count = 0 AND Tow_volume = 0, false)
  AND NOT COALESCE(Station = 'CVP N' AND Date BETWEEN DATE '1996-03-01' AND DATE '1996-03-31', false)
  AND NOT COALESCE(SampleID IN ('Salvage 7 1', 'Salvage 39 1'), false)"""

SQL["stn_job"] = r"""WITH smp AS (
  SELECT o.o_orderkey AS SampleRowID, o.o_orderdate AS SampleDate, CAST(month(o.o_orderdate) AS INTEGER) AS Survey,
         c.c_nationkey AS StationCode, abs(c.c_acctbal) / 400 AS TemperatureTop, o.o_totalprice / 10 AS ConductivityTop,
         3.0::DOUBLE AS TurbidityTop, 50.0::DOUBLE AS Secchi, (o.o_custkey % 3) + 1 AS TideCode,
         c.c_acctbal / 100 AS DepthBottom
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
li AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS flag_no FROM lineitem),
tow AS (SELECT l_orderkey * 10 + flag_no AS TowRowID, l_orderkey AS SampleRowID, flag_no AS TowNumber,
               lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(flag_no * 7 AS VARCHAR), 2, '0')
                 || ':30' AS TimeStart,
               flag_no AS MeterSerial,
               CASE WHEN min(l_tax) = 0 THEN NULL ELSE min(l_extendedprice) END AS MeterIn,
               max(l_quantity) * 1000 AS MeterOut, 100.0::DOUBLE AS CableOut, flag_no AS TowDirection
        FROM li GROUP BY l_orderkey, flag_no),
st AS (SELECT n_nationkey AS StationCode, 38 AS LatD, n_nationkey AS LatM, 0.0::DOUBLE AS LatS, 121 AS LonD,
              n_regionkey * 10 AS LonM, 30.0::DOUBLE AS LonS FROM nation),
corr AS (SELECT CAST(year(l_shipdate) + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 20 END AS INTEGER) AS Year,
                flag_no AS MeterSerial, avg(l_discount) + 0.01 AS k
         FROM li GROUP BY 1, 2),
s1 AS (SELECT smp.*, tow.TowRowID, tow.TowNumber, tow.TimeStart, tow.MeterSerial, tow.MeterIn, tow.MeterOut,
              tow.CableOut, tow.TowDirection, st.LatD, st.LatM, st.LatS, st.LonD, st.LonM, st.LonS,
              CAST(year(smp.SampleDate) AS INTEGER) AS Year
       FROM smp JOIN tow ON smp.SampleRowID = tow.SampleRowID LEFT JOIN st ON smp.StationCode = st.StationCode),
s2 AS (SELECT s1.*, corr.k,
              CASE WHEN MeterOut - MeterIn < 0 THEN MeterOut - MeterIn + 1000000.0::DOUBLE ELSE MeterOut - MeterIn END AS total
       FROM s1 LEFT JOIN corr ON s1.Year = corr.Year AND s1.MeterSerial = corr.MeterSerial),
s3 AS (SELECT TowRowID, 'STN' AS Source, CAST(StationCode AS VARCHAR) AS Station,
              LatD + LatM / 60.0::DOUBLE + LatS / 3600.0::DOUBLE AS Latitude,
              -(LonD + LonM / 60.0::DOUBLE + LonS / 3600.0::DOUBLE) AS Longitude,
              CAST(SampleDate AS DATE) AS Date,
              make_timestamp(year(SampleDate), month(SampleDate), day(SampleDate),
                             CAST(split_part(TimeStart, ':', 1) AS INTEGER), CAST(split_part(TimeStart, ':', 2) AS INTEGER),
                             CAST(split_part(TimeStart, ':', 3) AS INTEGER)) AS Datetime,
              Survey, DepthBottom * 0.3048::DOUBLE AS Depth,
              'STN ' || CAST(CAST(SampleDate AS DATE) AS VARCHAR) || ' ' || CAST(Survey AS VARCHAR) || ' '
                || CAST(StationCode AS VARCHAR) || ' ' || CAST(TowNumber AS VARCHAR) AS SampleID,
              'STN net' AS Method, TideCode, TowDirection, ConductivityTop * 0.001::DOUBLE AS C,
              TemperatureTop AS Temp_surf, TurbidityTop AS TurbidityNTU, Secchi,
              CASE WHEN TowRowID IN (6612, 12815, 2551, 12786, 8031, 1857) THEN 735.0::DOUBLE
                   ELSE COALESCE(CASE WHEN MeterIn IS NULL THEN 735.0::DOUBLE ELSE k * total * 1.49::DOUBLE END,
                                 735.0::DOUBLE) END AS Tow_volume,
              CableOut * 0.3048::DOUBLE AS Cable_length
       FROM s2),
sal_in AS (SELECT TowRowID, C FROM s3),
""" + _SAL_CHAIN + r""",
s AS (SELECT s3.*, CASE WHEN sh.sal > 40 THEN NULL ELSE sh.sal END AS Sal_surf,
             CASE s3.TideCode WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack' END AS Tide,
             CASE s3.TowDirection WHEN 1 THEN 'With current' WHEN 2 THEN 'Against current' WHEN 3 THEN 'Neither' END
               AS Tow_direction
      FROM s3 JOIN sh ON s3.TowRowID = sh.TowRowID),
ln AS (SELECT l.l_orderkey AS SampleID, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS brand_no,
              l.l_linenumber, l.l_quantity, l.l_discount, l.l_returnflag
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
ln2 AS (SELECT *, (SampleID * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) * 100 + brand_no
                    AS CatchRowID FROM ln),
cat AS (SELECT CatchRowID, CatchRowID // 100 AS TowRowID, brand_no AS OrganismCode,
               CAST(count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Catch
        FROM ln2 GROUP BY CatchRowID, brand_no),
pc AS (SELECT * FROM cat WHERE Catch IS NOT NULL AND Catch > 0),
meas AS (SELECT CatchRowID, ForkLength, sum(1.0::DOUBLE) AS LF FROM (
           SELECT CatchRowID, CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END AS ForkLength FROM ln2) t
         WHERE ForkLength <> 0 GROUP BY CatchRowID, ForkLength),
tot AS (SELECT CatchRowID, sum(LF) AS TM FROM meas GROUP BY CatchRowID),
j AS (SELECT pc.*, meas.ForkLength, meas.LF, COALESCE(tot.TM, 0.0) AS TM
      FROM pc LEFT JOIN meas ON pc.CatchRowID = meas.CatchRowID LEFT JOIN tot ON pc.CatchRowID = tot.CatchRowID),
k2 AS (SELECT *, CASE WHEN TM > Catch THEN TM ELSE Catch END AS CatchNew FROM j),
e AS (SELECT *, LF / NULLIF(TM, 0) * CatchNew AS ex FROM k2),
cl AS (SELECT e.TowRowID, xw.Taxa, e.ForkLength, e.LF, e.Catch,
              CASE WHEN e.Catch IS NOT NULL AND e.ex IS NULL THEN e.Catch ELSE e.ex END AS Count,
              CASE WHEN e.Catch IS NOT NULL AND e.ex IS NULL THEN 'Unknown length' END AS fl
       FROM e LEFT JOIN (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS STN_Code,
                                CASE WHEN CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) = 3 THEN p_brand || ' (Age 0)'
                                     ELSE p_brand END AS Taxa FROM part) xw
         ON e.OrganismCode = xw.STN_Code),
d AS (SELECT s.*, cl.Taxa, cl.ForkLength AS Length, cl.Catch, cl.Count,
             CASE WHEN cl.Catch IS NULL THEN 'No fish caught' ELSE cl.fl END AS flag
      FROM s LEFT JOIN cl ON s.TowRowID = cl.TowRowID),
d2 AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, Secchi, Tow_volume, Tow_direction, Cable_length,
              regexp_replace(Taxa, ' \(.*$', '') AS Taxa, Length,
              CASE WHEN flag = 'No fish caught' THEN 0.0 ELSE Count END AS Count, flag AS Length_NA_flag FROM d),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, Secchi, Tow_volume, Tow_direction, Cable_length, Taxa, Length, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime, Survey,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       Tow_direction, floor(Cable_length * 1000000.0 + 0.5) / 1000000.0 AS Cable_length, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM mg"""

SQL["baystudy_job"] = r"""WITH oc AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS Year, CAST(month(o.o_orderdate) AS INTEGER) AS Survey,
         CAST(c.c_nationkey AS VARCHAR) AS Station, o.o_orderkey, o.o_orderdate, o.o_orderstatus, o.o_totalprice,
         c.c_acctbal,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
              WHEN o.o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 2 ELSE 3 END AS Net
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
tc AS (SELECT * FROM (VALUES (1, 'High Slack'), (2, 'Ebb'), (3, 'Low Slack'), (4, 'Flood')) t(Tide, Description)),
bs AS (SELECT Year, Survey, Station, CAST(min(o_orderdate) AS DATE) AS Date, avg(c_acctbal) / 100 AS Depth,
              50.0::DOUBLE AS Secchi, (min(Survey) % 4) + 1 AS Tide
       FROM oc GROUP BY Year, Survey, Station),
bsd AS (SELECT bs.Year, bs.Survey, bs.Station, bs.Date, bs.Depth, bs.Secchi, tc.Description AS Tidestation
        FROM bs LEFT JOIN tc ON bs.Tide = tc.Tide),
bt0 AS (SELECT Year, Survey, Station, Net, CASE o_orderstatus WHEN 'P' THEN 52 WHEN 'F' THEN 1 ELSE 2 END AS Tow,
               max(o_orderdate) AS Time, sum(o_totalprice) / 100 AS TotalMeter, count(*) * 0.5::DOUBLE AS Distance
        FROM oc GROUP BY Year, Survey, Station, Net, o_orderstatus),
bt AS (SELECT b.Year, b.Survey, b.Station,
              CASE b.Net WHEN 1 THEN 'Midwater trawl' WHEN 2 THEN 'Otter trawl' WHEN 3 THEN 'EL' END AS Method,
              b.Time, b.Tow, tc.Description AS Tidetow,
              CASE b.Net WHEN 1 THEN 'With current' WHEN 2 THEN 'Against current' WHEN 3 THEN 'Slack or cross-current' END
                AS Tow_direction,
              CASE WHEN b.Net = 1 THEN b.TotalMeter * 0.02687::DOUBLE * 10.7::DOUBLE END AS Tow_volume,
              CASE WHEN b.Net = 2 THEN b.Distance * 1852.0::DOUBLE * 3.42::DOUBLE END AS Tow_area,
              CASE WHEN b.Tow IN (1, 2, 51, 54, 55, 56, 57) THEN 'Valid' WHEN b.Tow IN (0, 52, 53, 58) THEN 'Invalid' END
                AS Tow_status,
              10.0::DOUBLE AS Tow_duration, CAST(NULL AS VARCHAR) AS Notes_tow
       FROM bt0 b LEFT JOIN tc ON (CASE WHEN b.Net = 1 THEN NULL ELSE 2 END) = tc.Tide
       WHERE b.Net IN (1, 2)),
sal AS (SELECT Year, Survey, Station, avg(o_totalprice) / 10 AS ECSurf, avg(abs(c_acctbal)) / 400 AS TempSurf
        FROM oc GROUP BY Year, Survey, Station),
st AS (SELECT CAST(n_nationkey AS VARCHAR) AS Station,
              37.0::DOUBLE + CAST(n_nationkey * 2 AS DOUBLE) / 60.0::DOUBLE AS Latitude,
              -122.0::DOUBLE - CAST(n_regionkey * 5 AS DOUBLE) / 60.0::DOUBLE AS Longitude FROM nation),
env AS (SELECT bt.*, bsd.Date, bsd.Depth, bsd.Secchi, COALESCE(bt.Tidetow, bsd.Tidestation) AS Tide,
               make_timestamp(year(bsd.Date), month(bsd.Date), day(bsd.Date), hour(bt.Time), minute(bt.Time), 0)
                 AS Datetime,
               'Bay Study ' || CAST(bt.Year AS VARCHAR) || ' ' || CAST(bt.Survey AS VARCHAR) || ' ' || bt.Station || ' '
                 || bt.Method || ' ' || CAST(bt.Tow AS VARCHAR) || ' ' || CAST(bt.Time AS VARCHAR) AS SampleID,
               st.Latitude, st.Longitude, sal.ECSurf, sal.TempSurf AS Temp_surf
        FROM bt LEFT JOIN bsd ON bt.Year = bsd.Year AND bt.Survey = bsd.Survey AND bt.Station = bsd.Station
        LEFT JOIN st ON bt.Station = st.Station
        LEFT JOIN sal ON bt.Year = sal.Year AND bt.Survey = sal.Survey AND bt.Station = sal.Station),
sal_in AS (SELECT Year, Survey, Station, ECSurf * 0.001::DOUBLE AS C FROM sal),
""" + _SAL_CHAIN + r""",
ln AS (SELECT oc.Year, oc.Survey, oc.Station, oc.Net, l.l_quantity AS quantity, l.l_linenumber, l.l_tax,
              p.p_brand AS brand, CASE WHEN l.l_quantity < 25 THEN 1 ELSE 2 END AS SizeGroup
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN oc ON l.l_orderkey = oc.o_orderkey),
xw AS (SELECT DISTINCT upper(p_brand) AS code,
              CASE WHEN upper(p_brand) = 'BRAND#4' THEN p_brand || ' (Age 0)' ELSE p_brand END AS Taxa FROM part),
cat AS (SELECT c.Year, c.Survey, c.Station,
               CASE c.Net WHEN 1 THEN 'Midwater trawl' WHEN 2 THEN 'Otter trawl' END AS Method, c.SizeGroup, xw.Taxa,
               c.QtsCaught, c.QtsSubsampled, c.PlusCount
        FROM (SELECT Year, Survey, Station, Net, SizeGroup, upper(brand) AS AlphaCode, sum(quantity) / 10 AS QtsCaught,
                     CAST(count(*) AS DOUBLE) AS QtsSubsampled,
                     CASE WHEN max(l_tax) = 0 THEN NULL
                          ELSE CAST(count(*) FILTER (WHERE l_linenumber = 1) AS DOUBLE) END AS PlusCount
              FROM ln GROUP BY Year, Survey, Station, Net, SizeGroup, upper(brand)) c
        LEFT JOIN xw ON c.AlphaCode = xw.code WHERE c.Net IN (1, 2)),
len AS (SELECT l.Year, l.Survey, l.Station, CASE l.Net WHEN 1 THEN 'Midwater trawl' WHEN 2 THEN 'Otter trawl' END AS Method,
               l.SizeGroup, xw.Taxa, l.quantity AS Length, 1.0::DOUBLE AS Frequency
        FROM ln l LEFT JOIN xw ON upper(lower(l.brand)) = xw.code WHERE l.l_linenumber <> 1 AND l.Net IN (1, 2)),
tot AS (SELECT Year, Survey, Station, Method, SizeGroup, Taxa,
               CASE WHEN count(*) = count(Frequency) THEN sum(Frequency) END AS TM
        FROM len GROUP BY Year, Survey, Station, Method, SizeGroup, Taxa),
tcx AS (SELECT c.Year, c.Survey, c.Station, c.Method, c.SizeGroup, c.Taxa, t.TM,
               (t.TM + c.PlusCount) * (c.QtsCaught / NULLIF(c.QtsSubsampled, 0)) AS TotalCatch
        FROM cat c JOIN tot t ON c.Year = t.Year AND c.Survey = t.Survey AND c.Station = t.Station AND c.Method = t.Method
                            AND c.SizeGroup = t.SizeGroup AND c.Taxa IS NOT DISTINCT FROM t.Taxa
        WHERE c.PlusCount IS NOT NULL AND t.TM IS NOT NULL),
lc AS (SELECT l.Year, l.Survey, l.Station, l.Method, l.Taxa, l.Length,
              l.Frequency / NULLIF(x.TM, 0) * x.TotalCatch AS Count
       FROM len l LEFT JOIN tcx x ON l.Year = x.Year AND l.Survey = x.Survey AND l.Station = x.Station
                               AND l.Method = x.Method AND l.SizeGroup = x.SizeGroup AND l.Taxa IS NOT DISTINCT FROM x.Taxa),
d AS (SELECT 'Bay Study' AS Source, e.Station, e.Latitude, e.Longitude, e.Date, e.Datetime, e.Survey, e.Depth, e.SampleID,
             e.Method, e.Tide, sh.sal AS Sal_surf, e.Temp_surf, e.Secchi, e.Tow_duration, e.Tow_area, e.Tow_volume,
             e.Tow_direction, e.Notes_tow, e.Tow_status, regexp_replace(lc.Taxa, ' \(.*$', '') AS Taxa, lc.Length,
             lc.Count, CASE WHEN lc.Length IS NULL THEN 'No fish caught' END AS Length_NA_flag
      FROM env e LEFT JOIN lc ON e.Year = lc.Year AND e.Survey = lc.Survey AND e.Station = lc.Station AND e.Method = lc.Method
      LEFT JOIN sh ON e.Year = sh.Year AND e.Survey = sh.Survey AND e.Station = sh.Station),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, Secchi, Tow_duration, Tow_area, Tow_volume, Tow_direction, Notes_tow, Tow_status, Taxa, Length,
              Length_NA_flag, CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime, Survey,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi,
       floor(Tow_duration * 1000000.0 + 0.5) / 1000000.0 AS Tow_duration,
       floor(Tow_area * 1000000.0 + 0.5) / 1000000.0 AS Tow_area,
       floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume, Tow_direction, Notes_tow, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length,
       floor(CASE WHEN Length_NA_flag = 'No fish caught' THEN 0.0 ELSE Count END * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM mg WHERE Tow_status = 'Valid'"""

SQL["sls_job"] = r"""WITH oc AS (
  SELECT CAST(o.o_orderdate AS DATE) AS Date, c.c_nationkey AS Station, o.o_orderkey, o.o_totalprice, o.o_orderstatus,
         c.c_acctbal, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS Tow, CAST(month(o.o_orderdate) AS INTEGER) AS Survey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
water AS (SELECT Date, CASE WHEN Station < 20 THEN Station ELSE Station + 100 END AS Station, avg(o_totalprice) / 10 AS TopEC, avg(o_totalprice) / 8 AS BottomEC,
                 round_even(avg(abs(c_acctbal)) / 300, 2) AS Temp_surf, 50.0::DOUBLE AS Secchi,
                 min(Survey) AS NTU, min(Survey) + 1 AS FNU, CASE WHEN min(o_orderstatus) = 'F' THEN 'calm' END AS Notes_env
          FROM oc GROUP BY 1, 2),
corr AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS StudyYear, l_linenumber AS NetMeterSerial,
                avg(l_discount) + 0.01 AS kfactor,
                'meter ' || CAST(min(l_linenumber) AS VARCHAR) AS Notes_flowmeter FROM lineitem GROUP BY 1, 2),
tow0 AS (SELECT Date, Station, Tow, min(Survey) AS Survey, min(o_orderkey) % 24 AS h,
                (Tow % 4) + 1 AS TideCode, avg(c_acctbal) / 100 AS BottomDepth, Tow AS NetMeterSerial,
                sum(o_totalprice) / 10 AS NetMeterCheck, CASE WHEN count(*) > 1 THEN 'several' END AS Notes_tow
         FROM oc GROUP BY Date, Station, Tow),
tow AS (SELECT t.Date, t.Station, t.Tow, t.Survey, make_timestamp(year(t.Date), month(t.Date), day(t.Date), t.h, 15, 0)
                 AS Datetime,
               CASE t.TideCode WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack' WHEN 4 THEN 'Flood' END
                 AS Tide,
               t.BottomDepth * 0.3048::DOUBLE AS Depth, t.NetMeterCheck * c.kfactor * 0.37::DOUBLE AS Tow_volume,
               t.Notes_tow, 100.0::DOUBLE * 0.3048::DOUBLE AS Cable_length, t.Tow * 2.5::DOUBLE AS Tow_duration, c.Notes_flowmeter
        FROM tow0 t LEFT JOIN corr c ON CAST(year(t.Date) AS INTEGER) = c.StudyYear AND t.NetMeterSerial = c.NetMeterSerial),
ln AS (SELECT oc.Date, oc.Station, oc.Tow, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS FishCode,
              l.l_quantity, l.l_discount, l.l_linenumber
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN oc ON l.l_orderkey = oc.o_orderkey),
cat AS (SELECT Date, Station, Tow, FishCode, CAST(count(*) + count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Catch
        FROM ln GROUP BY Date, Station, Tow, FishCode),
lf AS (SELECT Date, Station, Tow, FishCode, l_quantity AS Length, CAST(count(*) AS DOUBLE) AS LengthFrequency
       FROM ln WHERE l_linenumber <> 1 GROUP BY Date, Station, Tow, FishCode, l_quantity),
lf2 AS (SELECT lf.*, sum(LengthFrequency) OVER (PARTITION BY Date, Station, Tow, FishCode) AS TLM FROM lf),
sal_in AS (SELECT Date, Station, 'top' AS w, TopEC * 0.001::DOUBLE AS C FROM water
           UNION ALL SELECT Date, Station, 'bot', BottomEC * 0.001::DOUBLE FROM water),
""" + _SAL_CHAIN + r""",
sal AS (SELECT Date, Station, max(CASE WHEN w = 'top' THEN sal END) AS Sal_surf,
               max(CASE WHEN w = 'bot' THEN sal END) AS Sal_bot FROM sh GROUP BY Date, Station),
w2 AS (SELECT water.*, sal.Sal_surf, sal.Sal_bot FROM water JOIN sal ON water.Date = sal.Date AND water.Station = sal.Station),
c1 AS (SELECT COALESCE(w2.Date, tow.Date) AS Date, COALESCE(w2.Station, tow.Station) AS Station,
              w2.Temp_surf, w2.Secchi, w2.Notes_env, w2.Sal_surf, w2.Sal_bot, w2.NTU, w2.FNU,
              tow.Tow, tow.Survey, tow.Datetime, tow.Tide, tow.Depth, tow.Tow_volume, tow.Notes_tow, tow.Cable_length, tow.Tow_duration, tow.Notes_flowmeter
       FROM w2 FULL JOIN tow ON w2.Date IS NOT DISTINCT FROM tow.Date AND w2.Station IS NOT DISTINCT FROM tow.Station),
c2 AS (SELECT COALESCE(c1.Date, cat.Date) AS Date, COALESCE(c1.Station, cat.Station) AS Station,
              COALESCE(c1.Tow, cat.Tow) AS Tow, c1.* EXCLUDE (Date, Station, Tow), cat.FishCode, cat.Catch
       FROM c1 FULL JOIN cat ON c1.Date IS NOT DISTINCT FROM cat.Date AND c1.Station IS NOT DISTINCT FROM cat.Station
                            AND c1.Tow IS NOT DISTINCT FROM cat.Tow),
c3 AS (SELECT COALESCE(c2.Date, lf2.Date) AS Date, COALESCE(c2.Station, lf2.Station) AS Station,
              COALESCE(c2.Tow, lf2.Tow) AS Tow, COALESCE(c2.FishCode, lf2.FishCode) AS FishCode,
              c2.* EXCLUDE (Date, Station, Tow, FishCode), lf2.Length, lf2.LengthFrequency, lf2.TLM
       FROM c2 FULL JOIN lf2 ON c2.Date IS NOT DISTINCT FROM lf2.Date AND c2.Station IS NOT DISTINCT FROM lf2.Station
                             AND c2.Tow IS NOT DISTINCT FROM lf2.Tow AND c2.FishCode IS NOT DISTINCT FROM lf2.FishCode),
xw AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS SLS_Code,
              CASE WHEN CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) = 5 THEN p_brand || ' (Age 0)'
                   ELSE p_brand END AS Taxa FROM part),
st AS (SELECT n_nationkey AS Station, 38.0::DOUBLE + n_nationkey * 0.01::DOUBLE AS Latitude,
              -121.5::DOUBLE - n_regionkey * 0.1::DOUBLE AS Longitude FROM nation),
c4 AS (SELECT c3.*, xw.Taxa, st.Latitude, st.Longitude,
              CASE WHEN c3.Length IS NULL THEN c3.Catch ELSE c3.LengthFrequency / NULLIF(c3.TLM, 0) * c3.Catch END AS Cnt,
              CASE WHEN COALESCE(c3.Notes_tow, c3.Notes_env) IS NULL THEN NULL
                   ELSE concat_ws('; ', c3.Notes_tow, c3.Notes_env) END AS Notes
       FROM c3 LEFT JOIN xw ON c3.FishCode IS NOT DISTINCT FROM xw.SLS_Code
       LEFT JOIN st ON c3.Station IS NOT DISTINCT FROM st.Station),
c5 AS (SELECT *, CASE WHEN Cnt IS NULL THEN 'No fish caught' WHEN Length IS NULL AND Cnt > 0 THEN 'Unknown length' END
                   AS flag FROM c4),
d2 AS (SELECT 'SLS' AS Source, CAST(Station AS VARCHAR) AS Station, Latitude, Longitude, Date, Datetime, Survey, Depth,
              concat_ws(' ', 'SLS', COALESCE(CAST(Date AS VARCHAR), 'NA'), COALESCE(CAST(Station AS VARCHAR), 'NA'),
                        COALESCE(CAST(Tow AS VARCHAR), 'NA')) AS SampleID,
              'Oblique tow' AS Method, Tide, Sal_surf, Sal_bot, Temp_surf, Secchi, NTU AS TurbidityNTU, FNU AS TurbidityFNU,
              Tow_volume, Cable_length, Tow_duration, Notes AS Notes_tow, Notes_flowmeter,
              regexp_replace(Taxa, ' \(.*$', '') AS Taxa, Length,
              CASE WHEN flag = 'No fish caught' THEN 0.0 ELSE Cnt END AS Count, flag AS Length_NA_flag FROM c5),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Sal_bot, Temp_surf, Secchi, TurbidityNTU, TurbidityFNU, Tow_volume, Cable_length, Tow_duration, Notes_tow,
              Notes_flowmeter, Taxa, Length, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime, Survey,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Sal_bot * 1000000.0 + 0.5) / 1000000.0 AS Sal_bot,
       floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf, floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi,
       TurbidityNTU, TurbidityFNU, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       floor(Cable_length * 1000000.0 + 0.5) / 1000000.0 AS Cable_length, floor(Tow_duration * 1000000.0 + 0.5) / 1000000.0 AS Tow_duration,
       Notes_tow, Notes_flowmeter, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM mg"""

SQL["skt_job"] = r"""WITH oc AS (
  SELECT o.o_orderkey AS SampleRowID, o.o_orderdate, c.c_nationkey AS StationCode, o.o_custkey, c.c_acctbal, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
smp AS (SELECT SampleRowID, CAST(StationCode AS VARCHAR) AS Station, CAST(o_orderdate AS DATE) AS Date,
               SampleRowID % 24 AS h, (o_custkey % 4) * 15 AS m,
               CAST(month(o_orderdate) AS INTEGER) AS Survey, abs(c_acctbal) / 400 AS Temp_surf,
               CASE CAST(o_custkey % 5 AS INTEGER) WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack'
                    WHEN 4 THEN 'Flood' END AS Tide,
               c_acctbal / 100 * 0.3048::DOUBLE AS Depth, 40.0::DOUBLE AS Secchi, o_totalprice / 10 AS CT,
               CAST(((SampleRowID + 37) % 100) * 10000 AS DOUBLE) - CAST((SampleRowID % 100) * 10000 AS DOUBLE) AS d0,
               CASE CAST(o_custkey % 4 AS INTEGER) WHEN 1 THEN 'With current' WHEN 2 THEN 'Against current'
                    WHEN 3 THEN 'Unknown' END AS Tow_direction,
               5.0::DOUBLE AS TurbidityNTU, 6.0::DOUBLE AS TurbidityFNU
        FROM oc),
st AS (SELECT CAST(n_nationkey AS VARCHAR) AS Station,
              38 + CAST(n_nationkey AS DOUBLE) / 60.0::DOUBLE + 0.0::DOUBLE / 3600.0::DOUBLE AS Latitude,
              -(121 + CAST(n_regionkey * 10 AS DOUBLE) / 60.0::DOUBLE + 15.0::DOUBLE / 3600.0::DOUBLE) AS Longitude
       FROM nation),
sal_in AS (SELECT SampleRowID, CT * 0.001::DOUBLE AS C FROM smp),
""" + _SAL_CHAIN + r""",
s AS (SELECT smp.*, st.Latitude, st.Longitude, sh.sal AS Sal_surf,
             CASE WHEN smp.h = 0 AND smp.m = 0 THEN NULL
                  ELSE make_timestamp(year(smp.Date), month(smp.Date), day(smp.Date), smp.h, smp.m, 0) END AS Datetime,
             (CASE WHEN smp.d0 < 0 THEN smp.d0 + 1000000.0::DOUBLE ELSE smp.d0 END) * 0.026873027::DOUBLE * 13.95::DOUBLE
               AS Tow_volume
      FROM smp LEFT JOIN st ON smp.Station = st.Station JOIN sh ON smp.SampleRowID = sh.SampleRowID),
ln AS (SELECT l.l_orderkey AS SampleID, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS OrganismCode,
              l.l_linenumber, l.l_quantity, l.l_discount
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
cat AS (SELECT SampleID * 100 + OrganismCode AS CatchRowID, SampleID AS SampleRowID, OrganismCode,
               CAST(count(*) + count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Catch
        FROM ln GROUP BY SampleID, OrganismCode
        UNION ALL
        SELECT o_orderkey * 100, o_orderkey, 0, CAST(NULL AS DOUBLE) FROM orders
        WHERE o_orderkey NOT IN (SELECT SampleID FROM ln)),
meas AS (SELECT CatchRowID, ForkLength, sum(1.0::DOUBLE) AS LF FROM (
           SELECT SampleID * 100 + OrganismCode AS CatchRowID,
                  CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END AS ForkLength FROM ln) t
         WHERE ForkLength <> 0 GROUP BY CatchRowID, ForkLength),
tot AS (SELECT CatchRowID, sum(LF) AS TM FROM meas GROUP BY CatchRowID),
cl0 AS (SELECT cat.*, meas.ForkLength, meas.LF, tot.TM,
               CASE WHEN tot.TM IS NULL THEN cat.Catch ELSE meas.LF / tot.TM * cat.Catch END AS Count
        FROM cat LEFT JOIN (meas JOIN tot ON meas.CatchRowID = tot.CatchRowID) ON cat.CatchRowID = meas.CatchRowID),
cl AS (SELECT cl0.SampleRowID, cl0.OrganismCode, xw.Taxa, cl0.ForkLength, cl0.Count
       FROM cl0 LEFT JOIN (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS code,
                                  CASE WHEN CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) = 6
                                       THEN p_brand || ' (Age 0)' ELSE p_brand END AS Taxa FROM part) xw
         ON cl0.OrganismCode = xw.code
       WHERE NOT (cl0.Count IS NULL AND COALESCE(cl0.OrganismCode <> 0, false))),
d AS (SELECT s.*, cl.OrganismCode, cl.Taxa, cl.ForkLength AS Length, cl.Count,
             CASE WHEN cl.OrganismCode = 0 THEN 'No fish caught'
                  WHEN cl.ForkLength IS NULL AND cl.Count > 0 THEN 'Unknown length' END AS flag
      FROM s LEFT JOIN cl ON s.SampleRowID = cl.SampleRowID),
d2 AS (SELECT 'SKT' AS Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth,
              'SKT ' || CAST(SampleRowID AS VARCHAR) AS SampleID, 'Kodiak trawl' AS Method, Tide, Sal_surf, Temp_surf,
              TurbidityNTU, TurbidityFNU, Secchi, Tow_volume, Tow_direction, regexp_replace(Taxa, ' \(.*$', '') AS Taxa,
              Length, CASE WHEN flag = 'No fish caught' THEN 0.0 ELSE Count END AS Count, flag AS Length_NA_flag FROM d),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, TurbidityFNU, Secchi, Tow_volume, Tow_direction, Taxa, Length, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime, Survey,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU,
       floor(TurbidityFNU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityFNU,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       Tow_direction, Taxa, floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length,
       floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count, Length_NA_flag
FROM mg"""

SQL["tmm_job"] = r"""WITH oc AS (
  SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_nationkey, c.c_acctbal,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS SurveyID
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
sv AS (SELECT SurveyID, min(o_orderdate) AS SampleDate, min(CAST(month(o_orderdate) AS INTEGER)) AS Survey
       FROM oc GROUP BY SurveyID),
stn AS (SELECT SurveyID * 100 + c_nationkey AS StationID, SurveyID, c_nationkey AS Station,
               avg(abs(c_acctbal)) / 400 AS Temp, avg(o_totalprice) / 10 AS TopEC, avg(c_acctbal) / 100 AS BottomDepth,
               30.0::DOUBLE AS Secchi, c_nationkey * 0.5::DOUBLE AS NTU, c_nationkey * 0.25::DOUBLE AS FNU, (c_nationkey % 4) + 1 AS Tide
        FROM oc GROUP BY SurveyID, c_nationkey),
tw AS (SELECT o_orderkey AS TowID, SurveyID * 100 + c_nationkey AS StationID, o_orderkey % 24 AS h FROM oc),
gear AS (SELECT o_orderkey * 10 + 2 AS GearID, o_orderkey AS TowID, 2 AS GearCode,
                CAST(o_orderkey % 7 AS INTEGER) AS MeterSerial, o_totalprice / 100 AS MeterCheck FROM orders
         UNION ALL SELECT o_orderkey * 10 + 1, o_orderkey, 1, CAST(o_orderkey % 7 AS INTEGER), 1.0::DOUBLE FROM orders),
corr AS (SELECT DISTINCT CAST(year(l_shipdate) + CASE WHEN l_linenumber % 2 = 0 THEN 20 ELSE 0 END AS INTEGER) AS StudyYear, l_linenumber - 1 AS MeterSerial,
                avg(l_discount) + 0.01 AS kFactor FROM lineitem GROUP BY 1, 2),
kavg AS (SELECT MeterSerial, avg(kFactor) AS kavg FROM corr GROUP BY MeterSerial),
ms AS (SELECT n_nationkey AS Station, 38 AS LatD, n_nationkey AS LatM, 30.0::DOUBLE AS LatS, 121 AS LonD,
              n_regionkey * 7 AS LonM, 0.0::DOUBLE AS LonS FROM nation),
s AS (SELECT g.GearID, g.MeterCheck, t.h, st.Station, st.Temp, st.TopEC, st.BottomDepth, st.Secchi, st.Tide, st.NTU, st.FNU,
             sv.SampleDate, sv.Survey, COALESCE(cy.kFactor, ka.kavg) AS k,
             ms.LatD, ms.LatM, ms.LatS, ms.LonD, ms.LonM, ms.LonS
      FROM sv JOIN stn st ON sv.SurveyID = st.SurveyID JOIN tw t ON st.StationID = t.StationID
      JOIN gear g ON t.TowID = g.TowID
      LEFT JOIN ms ON st.Station = ms.Station
      LEFT JOIN corr cy ON CAST(year(sv.SampleDate) AS INTEGER) = cy.StudyYear AND g.MeterSerial = cy.MeterSerial
      LEFT JOIN kavg ka ON g.MeterSerial = ka.MeterSerial
      WHERE g.GearCode = 2),
s3 AS (SELECT GearID, '20mm' AS Source, CAST(Station AS VARCHAR) AS Station,
              LatD + LatM / 60.0::DOUBLE + LatS / 3600.0::DOUBLE AS Latitude,
              -(LonD + LonM / 60.0::DOUBLE + LonS / 3600.0::DOUBLE) AS Longitude,
              CAST(SampleDate AS DATE) AS Date,
              make_timestamp(year(SampleDate), month(SampleDate), day(SampleDate), h, 20, 10) AS Datetime,
              Survey, BottomDepth * 0.3048::DOUBLE AS Depth, '20mm ' || CAST(GearID AS VARCHAR) AS SampleID,
              '20mm net' AS Method,
              CASE Tide WHEN 1 THEN 'High Slack' WHEN 2 THEN 'Ebb' WHEN 3 THEN 'Low Slack' WHEN 4 THEN 'Flood' END AS Tide,
              Temp AS Temp_surf, NTU AS TurbidityNTU, FNU AS TurbidityFNU, CAST(NULL AS VARCHAR) AS Tow_direction, TopEC * 0.001::DOUBLE AS C, Secchi, MeterCheck * k * 1.51::DOUBLE AS Tow_volume,
              50.0::DOUBLE * 0.3048::DOUBLE AS Cable_length
       FROM s),
sal_in AS (SELECT GearID, C FROM s3),
""" + _SAL_CHAIN + r""",
ln AS (SELECT l.l_orderkey AS SampleID, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS FishCode,
              l.l_linenumber, l.l_quantity, l.l_discount
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
fs AS (SELECT SampleID * 100 + FishCode AS FishSampleID, SampleID * 10 + 2 AS GearID, FishCode,
              CAST(count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS Catch
       FROM ln GROUP BY SampleID, FishCode),
meas AS (SELECT FishSampleID, Length, CAST(count(*) AS DOUBLE) AS LF FROM (
           SELECT SampleID * 100 + FishCode AS FishSampleID,
                  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS Length FROM ln) t
         WHERE Length IS NOT NULL GROUP BY FishSampleID, Length),
tot AS (SELECT FishSampleID, sum(LF) AS TM FROM meas GROUP BY FishSampleID),
j AS (SELECT fs.*, meas.Length, meas.LF, COALESCE(tot.TM, 0.0) AS TM
      FROM fs LEFT JOIN meas ON fs.FishSampleID = meas.FishSampleID LEFT JOIN tot ON fs.FishSampleID = tot.FishSampleID),
e AS (SELECT *, LF / NULLIF(TM, 0) * (CASE WHEN TM > Catch THEN TM ELSE Catch END) AS ex FROM j),
cl AS (SELECT e.GearID, xw.Taxa, e.Length, e.Catch,
              CASE WHEN e.Catch IS NOT NULL AND e.ex IS NULL THEN e.Catch ELSE e.ex END AS Count,
              CASE WHEN e.Catch IS NOT NULL AND e.ex IS NULL THEN 'Unknown length' END AS fl
       FROM e LEFT JOIN (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS code,
                                CASE WHEN CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) = 7 THEN p_brand || ' (Age 0)'
                                     ELSE p_brand END AS Taxa FROM part) xw ON e.FishCode = xw.code),
d AS (SELECT s3.*, sh.sal AS Sal_surf, cl.Taxa, cl.Length, cl.Catch, cl.Count,
             CASE WHEN cl.Catch IS NULL THEN 'No fish caught' ELSE cl.fl END AS flag
      FROM s3 JOIN sh ON s3.GearID = sh.GearID LEFT JOIN cl ON s3.GearID = cl.GearID),
d2 AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, TurbidityFNU, Tow_direction, Secchi, Tow_volume, Cable_length, regexp_replace(Taxa, ' \(.*$', '') AS Taxa, Length,
              CASE WHEN flag = 'No fish caught' THEN 0.0 ELSE Count END AS Count, flag AS Length_NA_flag FROM d),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Survey, Depth, SampleID, Method, Tide, Sal_surf,
              Temp_surf, TurbidityNTU, TurbidityFNU, Tow_direction, Secchi, Tow_volume, Cable_length, Taxa, Length, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count
       FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime, Survey,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU, floor(TurbidityFNU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityFNU,
       Tow_direction, floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       floor(Cable_length * 1000000.0 + 0.5) / 1000000.0 AS Cable_length, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length, floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM mg"""

SQL["edsm_job"] = r"""WITH sa AS (
  SELECT o.o_orderkey AS SampleRowID, o.o_orderstatus AS status, CAST(c.c_nationkey AS VARCHAR) AS StationCode,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS SampleDate,
         lpad(CAST(o.o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:30' AS SampleTime,
         CASE WHEN o.o_custkey % 3 = 0 THEN 'HS' WHEN o.o_custkey % 3 = 1 THEN 'LS' ELSE 'Flood' END AS Tide,
         -121.0::DOUBLE - n.n_regionkey AS LongitudeStart, 38.0::DOUBLE + c.c_nationkey AS LatitudeStart,
         CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS TowNumber,
         CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE CAST(o.o_custkey % 10 AS INTEGER) END AS GearConditionCode,
         o.o_totalprice / 10 AS SpecificConductanceTop, abs(c.c_acctbal) / 400 AS WaterTempTop,
         5.0::DOUBLE AS TurbidityTop, 0.5::DOUBLE AS Secchi, c.c_acctbal / 100 AS BottomDepth,
         CASE o.o_orderstatus WHEN 'F' THEN 'U' WHEN 'O' THEN 'D' ELSE 'X' END AS SamplingDirection,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN '20mm' WHEN '2' THEN 'KTS12' ELSE 'KDTR' END AS MethodCode,
         o.o_totalprice / 1000 AS sample_volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
ln AS (SELECT l.l_orderkey AS SampleRowID, l.l_linenumber, l.l_quantity, l.l_tax, l.l_extendedprice, l.l_returnflag,
              CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS brand_no
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
fish AS (SELECT sa.* EXCLUDE (SampleRowID, status, sample_volume),
                CASE ln.l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS FlowDebris,
                CASE WHEN ln.l_tax = 0 THEN 0.0::DOUBLE ELSE ln.l_extendedprice / 100 END AS Volume,
                CASE WHEN ln.brand_no = 1 THEN 'CHN' ELSE 'B' || CAST(ln.brand_no AS VARCHAR) END AS OrganismCode,
                CASE WHEN ln.l_linenumber = 1 THEN 0.0 ELSE ln.l_quantity END AS ForkLength,
                CAST(ceil(ln.l_quantity / 10) AS DOUBLE) AS Count,
                CASE WHEN ln.l_linenumber = 7 THEN 'AD' END AS MarkCode,
                CASE WHEN ln.l_quantity < 25 THEN 'Fall' ELSE 'Spring' END AS RaceByLength
         FROM ln JOIN sa ON ln.SampleRowID = sa.SampleRowID),
empt AS (SELECT sa.* EXCLUDE (SampleRowID, status, sample_volume), CAST(NULL AS VARCHAR) AS FlowDebris,
                sa.sample_volume AS Volume, 'NOFISH' AS OrganismCode, CAST(NULL AS DOUBLE) AS ForkLength,
                CAST(NULL AS DOUBLE) AS Count, CAST(NULL AS VARCHAR) AS MarkCode, CAST(NULL AS VARCHAR) AS RaceByLength
         FROM sa WHERE SampleRowID NOT IN (SELECT SampleRowID FROM ln)
            OR (status = 'F' AND SampleRowID IN (SELECT SampleRowID FROM ln))),
allr AS (SELECT * FROM fish UNION ALL SELECT * FROM empt),
e1 AS (SELECT * FROM allr WHERE GearConditionCode IS NULL OR GearConditionCode NOT IN (3, 4, 9)),
e2 AS (SELECT StationCode AS Station, CAST(SampleDate AS DATE) AS Date, SampleTime, Tide, LongitudeStart AS Longitude,
              LatitudeStart AS Latitude, TowNumber AS Tow,
              CASE WHEN FlowDebris IS NULL THEN Volume WHEN FlowDebris IN ('Y', 'Yes') THEN NULL ELSE Volume END AS v,
              SpecificConductanceTop AS Conductivity, WaterTempTop AS Temp_surf, TurbidityTop AS TurbidityNTU,
              Secchi * 100.0::DOUBLE AS Secchi, BottomDepth AS Depth0, SamplingDirection, MethodCode, OrganismCode,
              ForkLength AS Length, Count, MarkCode, RaceByLength
       FROM e1),
e3 AS (SELECT *, CASE WHEN v = 0 THEN NULL ELSE v END AS Tow_volume,
              make_timestamp(year(Date), month(Date), day(Date), CAST(split_part(SampleTime, ':', 1) AS INTEGER),
                             CAST(split_part(SampleTime, ':', 2) AS INTEGER), 0) AS Datetime,
              CASE WHEN Date < DATE '2019-06-01' THEN NULL ELSE Conductivity END * 0.001::DOUBLE AS C,
              CASE WHEN regexp_matches(MethodCode, '^K(D)?T(R|S\d+)') THEN 'Kodiak trawl'
                   WHEN regexp_matches(MethodCode, '^20mm$') THEN '20mm net' END AS Method
       FROM e2),
sal_in AS (SELECT DISTINCT C FROM e3 WHERE C IS NOT NULL),
""" + _SAL_CHAIN + r""",
e4 AS (SELECT e3.*, CASE WHEN sh.sal < 0 AND sh.sal > -0.1 THEN 0.0 WHEN sh.sal > 40 THEN NULL ELSE sh.sal END AS Sal_surf,
              CASE SamplingDirection WHEN 'U' THEN 'Upstream' WHEN 'D' THEN 'Downstream' ELSE SamplingDirection END
                AS Tow_direction,
              CASE WHEN Method = '20mm net' THEN Depth0 * 0.3048::DOUBLE ELSE Depth0 END AS Depth,
              CASE Tide WHEN 'HS' THEN 'High Slack' WHEN 'LS' THEN 'Low Slack' ELSE Tide END AS Tide2,
              concat_ws(' ', CAST(Datetime AS VARCHAR), COALESCE(Station, 'NA'), COALESCE(CAST(Tow AS VARCHAR), 'NA'),
                        COALESCE(Method, 'NA'), COALESCE(CAST(Latitude AS VARCHAR), 'NA'),
                        COALESCE(CAST(Longitude AS VARCHAR), 'NA')) AS SampleID,
              CASE WHEN COALESCE(MarkCode, 'None') = 'None' AND OrganismCode = 'CHN' THEN RaceByLength
                   WHEN COALESCE(MarkCode, 'None') <> 'None' THEN 'Tag ' || CAST(row_number() OVER () AS VARCHAR) END AS Grp
       FROM e3 LEFT JOIN sh ON e3.C = sh.C),
p0 AS (SELECT Station, Date, Tide2 AS Tide, Longitude, Latitude, Tow, Tow_volume, Temp_surf, TurbidityNTU, Secchi, Depth,
              Tow_direction, Method, OrganismCode, Length, Datetime, Sal_surf, SampleID, Grp,
              CASE WHEN OrganismCode = 'NOFISH' THEN NULL ELSE Count END AS Count FROM e4),
m AS (SELECT Station, Date, Tide, Longitude, Latitude, Tow, Tow_volume, Temp_surf, TurbidityNTU, Secchi, Depth,
             Tow_direction, Method, OrganismCode, Length, Datetime, Sal_surf, SampleID, Grp,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count FROM p0 GROUP BY ALL),
g AS (SELECT SampleID, OrganismCode, Grp,
             CASE WHEN count(*) FILTER (WHERE COALESCE(Length <> 0, false))
                       = count(Count) FILTER (WHERE COALESCE(Length <> 0, false))
                  THEN COALESCE(sum(Count) FILTER (WHERE COALESCE(Length <> 0, false)), 0.0) END AS measured,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS total
      FROM m GROUP BY SampleID, OrganismCode, Grp),
j AS (SELECT m.*, g.measured, g.total, COALESCE(g.measured = 0 AND m.Count > 0, false) AS inf
      FROM m JOIN g ON m.SampleID IS NOT DISTINCT FROM g.SampleID AND m.OrganismCode IS NOT DISTINCT FROM g.OrganismCode
                   AND m.Grp IS NOT DISTINCT FROM g.Grp),
kx AS (SELECT j.* EXCLUDE (Length, Count),
             CASE WHEN OrganismCode = 'NOFISH' THEN NULL WHEN inf AND Length = 0 THEN NULL ELSE Length END AS Length,
             CASE WHEN inf THEN total ELSE Count / NULLIF(measured, 0) * total END AS Count FROM j),
k2 AS (SELECT *, CASE WHEN inf THEN 'Unknown length' WHEN Length IS NULL THEN 'No fish caught' END AS Length_NA_flag
       FROM kx WHERE (Length <> 0 OR Length IS NULL)),
k3 AS (SELECT * FROM k2 WHERE Count <> 0 OR Count IS NULL),
mm AS (SELECT Station, Date, Tide, Longitude, Latitude, Tow, Tow_volume, Temp_surf, TurbidityNTU, Secchi, Depth,
              Tow_direction, Method, OrganismCode, Length, Datetime, Sal_surf, SampleID, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count FROM k3 GROUP BY ALL),
v AS (SELECT SampleID, COALESCE(sum(Count), 0.0) AS valid FROM mm GROUP BY SampleID),
sp AS (SELECT mm.* FROM mm LEFT JOIN v ON mm.SampleID IS NOT DISTINCT FROM v.SampleID
       WHERE NOT (v.valid > 0 AND COALESCE(mm.OrganismCode = 'NOFISH', false))),
xw AS (SELECT DISTINCT CASE WHEN code = 1 THEN 'CHN' ELSE 'B' || CAST(code AS VARCHAR) END AS USFWS_Code,
              CASE WHEN code = 9 THEN p_brand || ' (Age 0)' ELSE p_brand END AS Taxa
       FROM (SELECT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS code, p_brand FROM part) t),
fin AS (SELECT 'EDSM' AS Source, sp.Station, sp.Latitude, sp.Longitude, sp.Date, sp.Datetime, sp.Depth,
               'EDSM ' || sp.SampleID AS SampleID, sp.Method, sp.Tide, sp.Sal_surf, sp.Temp_surf, sp.TurbidityNTU, sp.Secchi,
               sp.Tow_volume, sp.Tow_direction, regexp_replace(xw.Taxa, ' \(.*$', '') AS Taxa, sp.Length,
               CASE WHEN sp.Length_NA_flag = 'No fish caught' THEN 0.0 ELSE sp.Count END AS Count, sp.Length_NA_flag
        FROM sp LEFT JOIN xw ON sp.OrganismCode IS NOT DISTINCT FROM xw.USFWS_Code
        WHERE sp.Method IS NOT NULL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       Tow_direction, Taxa, floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length,
       floor(Count * 1000000.0 + 0.5) / 1000000.0 AS Count, Length_NA_flag
FROM fin"""

SQL["djfmp_job"] = r"""WITH sa AS (
  SELECT o.o_orderkey AS SampleRowID, CAST(c.c_nationkey AS VARCHAR) AS StationCode,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS SampleDate, o.o_orderkey % 24 AS h,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS TowNumber, abs(c.c_acctbal) / 400 AS WaterTemp,
         3.0::DOUBLE AS Turbidity,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'SEIN' WHEN '2' THEN 'MWTR' ELSE 'KDTR' END AS MethodCode,
         c.c_acctbal / 100 AS SeineDepth,
         CASE o.o_orderstatus WHEN 'F' THEN 'U' WHEN 'O' THEN 'D' ELSE 'X' END AS SamplingDirection,
         o.o_totalprice / 10 AS SpecificConductance, 0.4::DOUBLE AS Secchi,
         CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE CAST(o.o_custkey % 10 AS INTEGER) END AS GearConditionCode,
         o.o_totalprice / 1000 AS sample_volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
ln AS (SELECT l.l_orderkey AS SampleRowID, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_returnflag,
              CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS brand_no
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
fish AS (SELECT sa.* EXCLUDE (SampleRowID, sample_volume), ln.l_extendedprice / 100 AS Volume,
                CASE ln.l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'Yes' END AS FlowDebris,
                CASE WHEN ln.l_linenumber = 1 THEN 0.0 ELSE ln.l_quantity END AS ForkLength,
                CASE WHEN ln.brand_no = 1 THEN 'CHN' ELSE 'B' || CAST(ln.brand_no AS VARCHAR) END AS OrganismCode,
                CAST(ceil(ln.l_quantity / 10) AS DOUBLE) AS Count,
                CASE WHEN ln.l_linenumber = 7 THEN 'AD' WHEN ln.l_linenumber % 2 = 1 THEN 'None' END AS MarkCode,
                CASE WHEN ln.l_quantity < 25 THEN 'Fall' ELSE 'Spring' END AS RaceByLength
         FROM ln JOIN sa ON ln.SampleRowID = sa.SampleRowID),
empt AS (SELECT sa.* EXCLUDE (SampleRowID, sample_volume), sa.sample_volume AS Volume, CAST(NULL AS VARCHAR) AS FlowDebris,
                CAST(NULL AS DOUBLE) AS ForkLength, 'NOFISH' AS OrganismCode, CAST(NULL AS DOUBLE) AS Count,
                CAST(NULL AS VARCHAR) AS MarkCode, CAST(NULL AS VARCHAR) AS RaceByLength
         FROM sa WHERE SampleRowID NOT IN (SELECT SampleRowID FROM ln)),
allr AS (SELECT * FROM fish UNION ALL SELECT * FROM empt),
e1 AS (SELECT * FROM allr WHERE GearConditionCode IS NULL OR GearConditionCode NOT IN (3, 4, 9)),
e2 AS (SELECT StationCode AS Station, CAST(SampleDate AS DATE) AS Date, h, TowNumber, WaterTemp AS Temp_surf,
              Turbidity AS TurbidityNTU,
              CASE MethodCode WHEN 'MWTR' THEN 'Midwater trawl' WHEN 'KDTR' THEN 'Kodiak trawl'
                              WHEN 'SEIN' THEN 'Beach seine' ELSE MethodCode END AS Method,
              CASE WHEN FlowDebris IS NULL THEN Volume WHEN FlowDebris = 'Y' THEN NULL ELSE Volume END AS Tow_volume,
              SeineDepth AS Depth,
              CASE SamplingDirection WHEN 'U' THEN 'Upstream' WHEN 'D' THEN 'Downstream' WHEN 'X' THEN 'Neither'
                   ELSE SamplingDirection END AS Tow_direction,
              ForkLength AS Length, SpecificConductance AS Conductivity, Secchi * 100.0::DOUBLE AS Secchi, OrganismCode,
              Count, CASE WHEN OrganismCode = 'NOFISH' THEN 'None' ELSE MarkCode END AS MarkCode, RaceByLength
       FROM e1),
e3 AS (SELECT *, CASE WHEN h = 0 THEN NULL ELSE make_timestamp(year(Date), month(Date), day(Date), h, 0, 0) END
                   AS Datetime,
              CASE WHEN Date < DATE '2019-06-01' THEN NULL ELSE Conductivity END * 0.001::DOUBLE AS C FROM e2),
sal_in AS (SELECT DISTINCT C FROM e3 WHERE C IS NOT NULL),
""" + _SAL_CHAIN + r""",
e4 AS (SELECT e3.*, sh.sal AS Sal_surf,
              concat_ws(' ', COALESCE(CAST(Datetime AS VARCHAR), CAST(Date AS VARCHAR)), COALESCE(Station, 'NA'),
                        COALESCE(CAST(TowNumber AS VARCHAR), 'NA'), COALESCE(Method, 'NA')) AS SampleID,
              CASE WHEN MarkCode = 'None' AND OrganismCode = 'CHN' THEN RaceByLength
                   WHEN MarkCode <> 'None' THEN 'Tag ' || CAST(row_number() OVER () AS VARCHAR) END AS Grp
       FROM e3 LEFT JOIN sh ON e3.C = sh.C),
m AS (SELECT Station, Date, TowNumber, Temp_surf, TurbidityNTU, Method, Tow_volume, Depth, Tow_direction, Length, Secchi,
             OrganismCode, Datetime, Sal_surf, SampleID, Grp,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count FROM e4 GROUP BY ALL),
g AS (SELECT SampleID, OrganismCode, Grp,
             CASE WHEN count(*) FILTER (WHERE COALESCE(Length <> 0, false))
                       = count(Count) FILTER (WHERE COALESCE(Length <> 0, false))
                  THEN COALESCE(sum(Count) FILTER (WHERE COALESCE(Length <> 0, false)), 0.0) END AS measured,
             CASE WHEN count(*) = count(Count) THEN sum(Count) END AS total
      FROM m GROUP BY SampleID, OrganismCode, Grp),
j AS (SELECT m.*, g.measured, g.total, COALESCE(g.measured = 0 AND m.Count > 0, false) AS inf
      FROM m JOIN g ON m.SampleID IS NOT DISTINCT FROM g.SampleID AND m.OrganismCode IS NOT DISTINCT FROM g.OrganismCode
                   AND m.Grp IS NOT DISTINCT FROM g.Grp),
kx AS (SELECT j.* EXCLUDE (Length, Count), CASE WHEN inf AND Length = 0 THEN NULL ELSE Length END AS Length,
              CASE WHEN inf THEN total ELSE Count / NULLIF(measured, 0) * total END AS Count FROM j),
k2 AS (SELECT *, CASE WHEN inf THEN 'Unknown length' WHEN Length IS NULL THEN 'No fish caught' END AS Length_NA_flag
       FROM kx WHERE Length <> 0 OR Length IS NULL),
st AS (SELECT CAST(n_nationkey AS VARCHAR) AS Station, 38.0::DOUBLE + n_nationkey * 0.01::DOUBLE AS Latitude,
              -121.5::DOUBLE - n_regionkey * 0.1::DOUBLE AS Longitude FROM nation),
xw AS (SELECT DISTINCT CASE WHEN code = 1 THEN 'CHN' ELSE 'B' || CAST(code AS VARCHAR) END AS USFWS_Code,
              CASE WHEN code = 11 THEN p_brand || ' (Age 0)' ELSE p_brand END AS Taxa
       FROM (SELECT CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER) AS code, p_brand FROM part) t),
d2 AS (SELECT 'DJFMP' AS Source, k2.Station, st.Latitude, st.Longitude, k2.Date, k2.Datetime, k2.Depth,
              'DJFMP ' || k2.SampleID AS SampleID, k2.Method, k2.Sal_surf, k2.Temp_surf, k2.TurbidityNTU, k2.Secchi,
              k2.Tow_volume, k2.Tow_direction, regexp_replace(xw.Taxa, ' \(.*$', '') AS Taxa, k2.Length, k2.Count,
              k2.Length_NA_flag
       FROM k2 LEFT JOIN st ON k2.Station IS NOT DISTINCT FROM st.Station
       LEFT JOIN xw ON k2.OrganismCode IS NOT DISTINCT FROM xw.USFWS_Code),
mg AS (SELECT Source, Station, Latitude, Longitude, Date, Datetime, Depth, SampleID, Method, Sal_surf, Temp_surf,
              TurbidityNTU, Secchi, Tow_volume, Tow_direction, Taxa, Length, Length_NA_flag,
              CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count FROM d2 GROUP BY ALL)
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(TurbidityNTU * 1000000.0 + 0.5) / 1000000.0 AS TurbidityNTU,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi, floor(Tow_volume * 1000000.0 + 0.5) / 1000000.0 AS Tow_volume,
       Tow_direction, CASE WHEN Length_NA_flag = 'No fish caught' THEN NULL ELSE Taxa END AS Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length,
       floor(CASE WHEN Length_NA_flag = 'No fish caught' THEN 0.0 ELSE Count END * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag
FROM mg"""

SQL["suisun_job"] = r"""WITH smp AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS SampleRowID, substr(o.o_orderpriority, 1, 1) IN ('2', '3', '4') AS otter,
         CAST(c.c_nationkey AS VARCHAR) AS Station, CAST(o.o_orderdate AS DATE) AS Date, o.o_orderkey % 24 AS h,
         abs(c.c_acctbal) / 400 AS Temp_surf, 45.0::DOUBLE AS Secchi, o.o_totalprice / 10 AS SC,
         CASE WHEN o.o_custkey % 7 = 0 THEN 'turning' ELSE
           CASE o.o_custkey % 4 WHEN 0 THEN 'Flood' WHEN 1 THEN 'Ebb' WHEN 2 THEN NULL ELSE 'Ebb' END END AS Tide,
         5.0::DOUBLE + o.o_orderkey % 10 AS Tow_duration,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'net ' || CAST(o.o_orderkey AS VARCHAR) END AS Notes_tow
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dep AS (SELECT CAST(l_orderkey AS VARCHAR) AS SampleRowID, avg(l_quantity / 10) AS Depth FROM lineitem GROUP BY l_orderkey),
st AS (SELECT CAST(n_nationkey AS VARCHAR) AS Station, 38.0::DOUBLE + n_nationkey * 0.01::DOUBLE AS Latitude,
              -122.0::DOUBLE - n_regionkey * 0.01::DOUBLE AS Longitude FROM nation),
-- only otter trawls
s0 AS (SELECT smp.*, 'Suisun {' || smp.SampleRowID || '}' AS SampleID, 'Otter trawl' AS Method,
              make_timestamp(year(smp.Date), month(smp.Date), day(smp.Date), smp.h, 30, 0) AS Datetime,
              SC * 0.001::DOUBLE AS C, dep.Depth, st.Latitude, st.Longitude,
              smp.Tow_duration / 60.0::DOUBLE * 4000.0::DOUBLE * 4.3::DOUBLE * 0.7::DOUBLE AS Tow_area
       FROM smp LEFT JOIN dep ON smp.SampleRowID = dep.SampleRowID LEFT JOIN st ON smp.Station = st.Station
       WHERE otter),
sal_in AS (SELECT SampleID, C FROM s0),
""" + _SAL_CHAIN + r""",
s AS (SELECT s0.*, sh.sal AS Sal_surf FROM s0 JOIN sh ON s0.SampleID = sh.SampleID),
ln AS (SELECT CAST(l.l_orderkey AS VARCHAR) AS SampleRowID, 'Suisun {' || CAST(l.l_orderkey AS VARCHAR) || '}' AS SampleID,
              l.l_linenumber, l.l_quantity, l.l_discount, month(o.o_orderdate) AS Month, round(l.l_tax * 100) AS t,
              round(l.l_discount * 100) AS dc, p.p_brand, CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) AS code,
              CASE WHEN CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) = 13 THEN p.p_brand || ' (Age 0)'
                   ELSE p.p_brand END AS Taxa,
              CASE WHEN l.l_linenumber = 1 THEN 0.0 ELSE l.l_quantity END AS SL,
              CASE WHEN l.l_discount >= 0.05 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS Count,
              CASE WHEN l.l_linenumber <> 1 THEN NULL WHEN round(l.l_discount * 100) > 5 THEN '<' || CAST(l.l_linenumber AS VARCHAR)
                   WHEN round(l.l_discount * 100) = 2 THEN '~' WHEN round(l.l_discount * 100) = 1 THEN 'YOY'
                   WHEN round(l.l_discount * 100) = 3 THEN 'with eggs' END AS note
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey),
-- rows of trawls that were not made go; "no catch" rows have neither fish nor length
c AS (SELECT s.SampleID, CASE WHEN t <> 7 THEN ln.Taxa END AS Taxa, CASE WHEN t = 7 THEN 0.0 ELSE ln.Count END AS Count,
             CASE WHEN t <> 7 THEN ln.SL END AS SL, note
      FROM ln JOIN s ON ln.SampleRowID = s.SampleRowID WHERE t <> 8),
ages AS (SELECT Month, code, CASE WHEN code % 2 = 0 THEN 'Age-0' ELSE 'Age-1' END AS Class, min(l_quantity) AS mn, max(l_quantity) AS mx
         FROM ln GROUP BY Month, code),
com AS (
  SELECT ln.SampleID, ln.Taxa, ln.Count, ln.note, CASE WHEN dc = 2 THEN l_quantity END AS Length,
         CASE WHEN dc = 1 THEN ages.mn END AS mn, CASE WHEN dc > 5 THEN l_quantity WHEN dc = 1 THEN ages.mx END AS mx
  FROM ln LEFT JOIN ages ON dc = 1 AND ages.Month = ln.Month AND ages.code = ln.code AND ages.Class = 'Age-0'
  WHERE l_linenumber = 1 AND t NOT IN (7, 8) AND (dc > 5 OR dc IN (1, 2))),  -- comments to ignore left out
rng AS (SELECT *, CAST(row_number() OVER (PARTITION BY SampleID, Taxa ORDER BY mn NULLS FIRST, mx NULLS FIRST, Count, Length NULLS FIRST, note)
                       + 1 AS INTEGER) AS g
        FROM com WHERE mn IS NOT NULL OR mx IS NOT NULL),
cc AS (
  SELECT SampleID, Taxa, note, Count, g AS SizeGroup,
         CASE WHEN Length IS NOT NULL THEN Length
              WHEN NOT EXISTS (SELECT 1 FROM c WHERE c.SampleID = rng.SampleID AND c.Taxa = rng.Taxa AND c.SL > 0) THEN NULL
              ELSE 0 END AS SL FROM rng
  UNION ALL SELECT SampleID, Taxa, note, Count, 1, Length FROM com WHERE mn IS NULL AND mx IS NULL),
rows_ AS (
  SELECT c.SampleID, c.Taxa, c.note, c.Count, c.SL, NULL AS flag, 'N' AS Dead,
         COALESCE((SELECT min(r.g) FROM rng r WHERE r.SampleID = c.SampleID AND r.Taxa = c.Taxa
                   AND c.SL < COALESCE(r.mx, 'inf'::DOUBLE) AND c.SL > COALESCE(r.mn, '-inf'::DOUBLE)), 1) AS SizeGroup
  FROM c WHERE c.SL > 0
  UNION ALL
  SELECT c.SampleID, c.Taxa, c.note, c.Count, c.SL, CASE WHEN c.SL IS NULL THEN 'No fish caught' END, 'N', 1 FROM c
  WHERE c.SL IS NULL
     OR c.SL = 0 AND NOT EXISTS (SELECT 1 FROM com WHERE com.SampleID = c.SampleID AND com.Taxa = c.Taxa)
  UNION ALL
  SELECT SampleID, Taxa, note, Count, SL, CASE WHEN SL IS NULL THEN 'Unknown length' END, NULL, SizeGroup FROM cc
  WHERE SampleID IN (SELECT SampleID FROM s)),
agg AS (SELECT SampleID, Taxa, SizeGroup,
               CASE WHEN count(*) FILTER (WHERE SL <> 0 OR SL IS NULL) > 0
                    THEN COALESCE(sum(Count) FILTER (WHERE SL <> 0 OR SL IS NULL), 0.0) END AS TM,
               COALESCE(sum(Count), 0.0) AS TC
        FROM rows_ GROUP BY SampleID, Taxa, SizeGroup),
ex AS (SELECT r.SampleID, r.Taxa, r.note, CASE WHEN a.TM IS NULL THEN NULL ELSE r.SL END AS Length,
              CASE WHEN a.TM IS NULL OR a.TM = 0 THEN r.Count ELSE r.Count / a.TM * a.TC END AS Count,
              CASE WHEN a.TM IS NULL THEN 'Unknown length' ELSE r.flag END AS Length_NA_flag
       FROM rows_ r JOIN agg a ON r.SampleID = a.SampleID AND r.Taxa IS NOT DISTINCT FROM a.Taxa AND r.SizeGroup = a.SizeGroup
       WHERE (r.SL <> 0 OR r.SL IS NULL) OR a.TM IS NULL),
d AS (SELECT 'Suisun' AS Source, s.Station, s.Latitude, s.Longitude, s.Date, s.Datetime, s.Depth, s.SampleID, s.Method,
             s.Tide, s.Sal_surf, s.Temp_surf, s.Secchi, s.Tow_duration, s.Tow_area,
             CASE WHEN ex.Count <> 0 THEN regexp_replace(ex.Taxa, ' \(.*$', '') END AS Taxa,
             CASE WHEN ex.Count <> 0 AND ex.Taxa IS NOT NULL THEN ex.Length END AS Length,
             CASE WHEN ex.Count <> 0 AND ex.Taxa IS NOT NULL THEN ex.Count END AS Count, ex.Length_NA_flag,
             CASE WHEN ex.Count <> 0 AND ex.Taxa IS NOT NULL THEN ex.note END AS Notes_catch, s.Notes_tow
      FROM s JOIN ex ON s.SampleID = ex.SampleID),
mg AS (SELECT * EXCLUDE (Count), CASE WHEN count(*) = count(Count) THEN sum(Count) END AS Count FROM d GROUP BY ALL),
v AS (SELECT SampleID, COALESCE(sum(Count), 0.0) > 0 AS valid FROM mg GROUP BY SampleID),
f AS (SELECT DISTINCT mg.* EXCLUDE (Length_NA_flag), v.valid,
             CASE WHEN v.valid THEN mg.Length_NA_flag ELSE 'No fish caught' END AS Length_NA_flag
      FROM mg JOIN v ON mg.SampleID = v.SampleID),
f2 AS (SELECT * FROM f WHERE NOT (valid AND Count IS NULL))
SELECT Source, Station, floor(Latitude * 1000000.0 + 0.5) / 1000000.0 AS Latitude,
       floor(Longitude * 1000000.0 + 0.5) / 1000000.0 AS Longitude, Date, CAST(Datetime AS VARCHAR) AS Datetime,
       floor(Depth * 1000000.0 + 0.5) / 1000000.0 AS Depth, SampleID, Method, Tide,
       floor(Sal_surf * 1000000.0 + 0.5) / 1000000.0 AS Sal_surf, floor(Temp_surf * 1000000.0 + 0.5) / 1000000.0 AS Temp_surf,
       floor(Secchi * 1000000.0 + 0.5) / 1000000.0 AS Secchi,
       floor(Tow_duration * 1000000.0 + 0.5) / 1000000.0 AS Tow_duration,
       floor(Tow_area * 1000000.0 + 0.5) / 1000000.0 AS Tow_area, Taxa,
       floor(Length * 1000000.0 + 0.5) / 1000000.0 AS Length,
       floor(CASE WHEN Length_NA_flag = 'No fish caught' THEN 0.0 ELSE Count END * 1000000.0 + 0.5) / 1000000.0 AS Count,
       Length_NA_flag, Notes_catch, Notes_tow
FROM f2"""


# -- measured lengths and the ten-source integration: the jobs' own steps, another last one --

def _ending(job: str, select: str) -> str:
    """A job's SQL with another final SELECT."""
    text = SQL[job]
    return text[:text.rindex("\nSELECT Source")] + "\n" + select


def _q6(c: str) -> str:
    return f"floor({c} * 1000000.0 + 0.5) / 1000000.0"


_BARE = r"regexp_replace({0}, ' \(.*$', '')"
_MEASURED = {
    "fmwt": f"""SELECT 'FMWT ' || CAST(k.SampleRowID AS VARCHAR) AS SampleID, {_BARE.format('k.Taxa')} AS Taxa,
       {_q6('meas.ForkLength')} AS Length, {_q6('sum(meas.LF)')} AS Count
FROM meas LEFT JOIN (SELECT ct.* FROM ct JOIN s ON s.SampleRowID = ct.SampleRowID) k
  ON meas.SampleRowID = k.SampleRowID AND meas.OrganismCode = k.OrganismCode
GROUP BY k.SampleRowID, {_BARE.format('k.Taxa')}, meas.ForkLength""",
    "skt": f"""SELECT 'SKT ' || CAST(cl0.SampleRowID AS VARCHAR) AS SampleID, {_BARE.format('p.Taxa')} AS Taxa,
       {_q6('cl0.ForkLength')} AS Length, {_q6('sum(cl0.LF)')} AS Count
FROM cl0 LEFT JOIN (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS code, p_brand AS Taxa FROM part) p
  ON cl0.OrganismCode = p.code
WHERE cl0.LF IS NOT NULL GROUP BY cl0.SampleRowID, {_BARE.format('p.Taxa')}, cl0.ForkLength""",
    "stn": f"""SELECT s.SampleID, {_BARE.format('cl.Taxa')} AS Taxa, {_q6('cl.ForkLength')} AS Length, {_q6('cl.LF')} AS Count
FROM s JOIN cl ON s.TowRowID = cl.TowRowID WHERE cl.LF IS NOT NULL""",
    "tmm": f"""SELECT s3.SampleID, p.Taxa, {_q6('e.Length')} AS Length, {_q6('e.LF')} AS Count
FROM s3 JOIN e ON s3.GearID = e.GearID
LEFT JOIN (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS code, p_brand AS Taxa FROM part) p
  ON e.FishCode = p.code
WHERE e.LF IS NOT NULL""",
    "sls": f"""SELECT 'SLS ' || CAST(Date AS VARCHAR) || ' ' || CAST(Station AS VARCHAR) || ' ' || CAST(Tow AS VARCHAR) AS SampleID,
       {_BARE.format('Taxa')} AS Taxa, {_q6('Length')} AS Length, {_q6('LengthFrequency')} AS Count
FROM c5 WHERE LengthFrequency IS NOT NULL""",
    "baystudy": f"""SELECT e.SampleID, {_BARE.format('l.Taxa')} AS Taxa, l.SizeGroup AS Size_group, {_q6('l.Length')} AS Length,
       {_q6('l.Frequency')} AS Count
FROM len l JOIN env e ON e.Year = l.Year AND e.Survey = l.Survey AND e.Station = l.Station AND e.Method = l.Method
WHERE e.Tow_status = 'Valid'""",
    "suisun": f"""SELECT SampleID, {_BARE.format('Taxa')} AS Taxa, Dead, {_q6('SL')} AS Length, {_q6('Count')} AS Count
FROM rows_ WHERE SL <> 0""",
    "salvage": f"""SELECT ids.SampleID, e5.Taxa2 AS Taxa, {_q6('e5.Length')} AS Length, {_q6('e5.LengthFrequency')} AS Count
FROM e5 LEFT JOIN ids ON e5.Facility IS NOT DISTINCT FROM ids.Facility AND e5.Location IS NOT DISTINCT FROM ids.Location
                     AND e5.SampleRowID IS NOT DISTINCT FROM ids.SampleRowID
WHERE e5.LengthFrequency IS NOT NULL""",
}
SQL.update({f"measured_{k}": _ending(f"{k}_job", v) for k, v in _MEASURED.items()})

_ALL = " UNION ALL BY NAME ".join(
    f"SELECT * FROM ({SQL[f'{k}_job']})"
    for k in ("fmwt", "skt", "stn", "tmm", "sls", "edsm", "djfmp", "baystudy", "suisun", "salvage"))
SQL["integrate_all"] = f"""WITH everything AS ({_ALL}),
survey AS (SELECT Source, count(*) AS n_samples, min(Date) AS first_date, max(Date) AS last_date
           FROM (SELECT DISTINCT * EXCLUDE (Taxa, Length, Count, Length_NA_flag, Notes_catch) FROM everything) GROUP BY Source),
fish AS (SELECT DISTINCT Source, SampleID, Taxa, Length, Count, Notes_catch FROM everything),
grid AS (SELECT s.Source, s.SampleID, t.Taxa FROM (SELECT DISTINCT Source, SampleID FROM fish) s
         JOIN (SELECT DISTINCT Source, Taxa FROM fish WHERE Taxa IS NOT NULL) t ON s.Source = t.Source),
filled AS (SELECT g.Source, g.SampleID, g.Taxa, COALESCE(f.Count, 0) AS Count
           FROM grid g LEFT JOIN fish f ON f.Source = g.Source AND f.SampleID = g.SampleID AND f.Taxa = g.Taxa)
SELECT filled.Source, Taxa, count(*) AS n_rows, count(*) FILTER (WHERE Count > 0) AS n_caught, round(sum(Count), 3) AS total,
       any_value(n_samples) AS n_samples, any_value(first_date) AS first_date, any_value(last_date) AS last_date
FROM filled JOIN survey ON survey.Source = filled.Source
WHERE NOT (Taxa = 'UnID' AND Count = 0) GROUP BY filled.Source, Taxa"""

SQL["quality_by_source"] = ds_with() + "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, Source, count(*) AS violations, min(SampleID) AS first_sample, max(SampleID) AS last_sample "
    f"FROM dataset WHERE {cond} GROUP BY Source" for name, cond in _QUALITY_RULES)
SQL["stn_checks"] = "WITH dataset AS (" + SQL["stn_job"] + ")\n" + _rule_union([
    ("domain_Source", "NOT COALESCE(Source = 'STN', false)"),
    ("domain_Station", "NOT COALESCE(CAST(Station AS INTEGER) BETWEEN 0 AND 19, false)"),
    ("format_SampleID", "NOT COALESCE(regexp_matches(SampleID, '^STN [0-9]+'), false)"),
    ("range_Survey", "Survey < 1 OR Survey > 6"), ("range_Depth", "Depth < 0.0 OR Depth > 30.0"),
    ("q2_date_type", "false"), ("q2_date_format", "Date IS NULL"), ("q2_datetime_type", "false")])
SQL["sinks_survey_csv"] = SQL["normalise_survey"]
SQL["sinks_fish_parquet"] = SQL["normalise_fish"]
SQL["publication"] = SQL["coverage"]
SQL["species_crosswalk"] = """WITH p AS (
  SELECT DISTINCT p_brand AS ScientificName, CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS n FROM part)
SELECT ScientificName, CASE WHEN n % 3 <> 0 THEN n END AS STN_Code, 'C' || CAST(n AS VARCHAR) AS SKT_Code,
       CASE WHEN n % 5 = 0 THEN 'Age 0' END AS Lifestage,
       CASE WHEN n % 5 = 0 THEN ScientificName || ' (Age 0)' ELSE ScientificName END AS Taxa,
       CASE WHEN n % 3 <> 0 THEN n END AS Looked_up
FROM p"""
SQL["typed_projection"] = """SELECT l_orderkey AS SampleID, l_linenumber AS Tow,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS Length, CAST(l_shipdate AS DATE) AS Date,
       CAST(timezone('UTC', timezone('America/Los_Angeles', make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate),
                                                                       12, l_linenumber, 0))) AS VARCHAR) AS Utc
FROM lineitem"""

# -- sparse store, versions, checks at publishing -----------------------------------

# The zero-filled table in full (Z1, Z2), then sliced.
_FILLED = """dom AS (SELECT DISTINCT Source, Taxa FROM ft WHERE Taxa IS NOT NULL),
smp AS (SELECT DISTINCT Source, SampleID FROM ft),
filled AS (
  SELECT SampleID, Taxa, Length, COALESCE(Count, 0.0) AS Count FROM ft WHERE Taxa IS NOT NULL
  UNION ALL
  SELECT smp.SampleID, dom.Taxa, NULL, 0.0 FROM smp JOIN dom ON smp.Source = dom.Source
  WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.SampleID = smp.SampleID AND ft.Taxa = dom.Taxa)),
kept AS (SELECT * FROM filled WHERE NOT (Taxa = 'UnID' AND Count = 0))"""
_SLICED = """s AS (SELECT DISTINCT Source, SampleID, Date FROM dataset
       WHERE Source IN ('F', 'O') AND month(Date) IN (1, 2, 3, 4, 5, 6) AND year(Date) BETWEEN 1996 AND 2000)"""

SQL["sparse_slice"] = ds_with(FISH_T, _FILLED, _SLICED) + """
SELECT s.SampleID, s.Source, s.Date, k.Taxa, k.Length, floor(k.Count * 1000000.0 + 0.5) / 1000000.0 AS Count
FROM s LEFT JOIN (SELECT * FROM kept WHERE Taxa IN ('Brand#13', 'Brand#2', 'UnID')) k ON s.SampleID = k.SampleID"""

SQL["sparse_slice_aggregate"] = ds_with(FISH_T, _FILLED, _SLICED, """fa AS (
  SELECT k.SampleID, k.Taxa, COALESCE(sum(k.Count), 0.0) AS Count FROM kept k JOIN s ON k.SampleID = s.SampleID
  WHERE k.Length IS NULL OR (s.Source = 'O' AND k.Length BETWEEN 10.0 AND 40.0) OR (s.Source <> 'O' AND k.Length BETWEEN 5.0 AND 45.0)
  GROUP BY k.SampleID, k.Taxa)""") + """
SELECT s.SampleID, s.Source, s.Date, fa.Taxa, floor(fa.Count * 1000000.0 + 0.5) / 1000000.0 AS Count
FROM s LEFT JOIN fa ON s.SampleID = fa.SampleID"""

SQL["replace_source"] = with_(LINES, SAMPLES, FISH) + """
SELECT Source, SampleID, Taxa, Length, CASE WHEN Source = 'P' THEN 2 * Count ELSE Count END AS Count
FROM fish WHERE Source <> 'P' OR Taxa IS NOT NULL"""

SQL["publish_checks"] = with_(LINES, SAMPLES, """t AS (
  SELECT s.Source, l.SampleID, l.Taxa,
         CASE l.linenumber WHEN 3 THEN 'n/p' WHEN 5 THEN NULL ELSE CAST(l.Length AS VARCHAR) END AS LengthText,
         CASE WHEN l.linenumber = 2 THEN '13/32/99' ELSE CAST(s.Date AS VARCHAR) END AS DateText
  FROM lines l JOIN samples s ON l.SampleID = s.SampleID),
c AS (
  SELECT Source, SampleID, Taxa, TRY_CAST(LengthText AS DOUBLE) AS Length,
         CASE WHEN DateText = '13/32/99' THEN NULL ELSE CAST(DateText AS DATE) END AS Date,
         CAST(LengthText = 'n/p' AS INTEGER) AS bad_length, CAST(DateText = '13/32/99' AS INTEGER) AS bad_date
  FROM t),
o AS (SELECT DISTINCT Source, SampleID, Taxa, Length, Date FROM c)""") + """
SELECT 'failed_Date' AS "check", CAST(sum(bad_date) AS BIGINT) AS value FROM c
UNION ALL SELECT 'failed_Length', CAST(sum(bad_length) AS BIGINT) FROM c
UNION ALL SELECT 'failed_SampleID', 0
UNION ALL SELECT 'no_date', count(*) FILTER (WHERE Date IS NULL) FROM o
UNION ALL SELECT 'range_Length', count(*) FILTER (WHERE Length < 1.0 OR Length > 45.0) FROM o
UNION ALL SELECT 'rows_in', count(*) FROM c
UNION ALL SELECT 'rows_lost', (SELECT count(*) FROM c) - (SELECT count(*) FROM o)
UNION ALL SELECT 'rows_out', count(*) FROM o"""

SQL["broken_samples"] = ds_with() + "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, Source, CAST(sum(n) AS BIGINT) AS violations, count(*) AS samples, "
    f"array_to_string(list(SampleID ORDER BY SampleID)[1:3], ',') AS keys "
    f"FROM (SELECT Source, SampleID, count(*) AS n FROM dataset WHERE {cond} GROUP BY Source, SampleID) x GROUP BY Source"
    for name, cond in _QUALITY_RULES)

SQL["sample_fingerprints"] = ds_with(FISH_T, """svy AS (SELECT DISTINCT Source, SampleID FROM dataset),
h AS (
  SELECT Source, SampleID, CAST('0x' || substr(m, 1, 15) AS BIGINT) AS a, CAST('0x' || substr(m, 17, 15) AS BIGINT) AS b
  FROM (SELECT Source, SampleID, md5('v' || CAST(SampleID AS VARCHAR)) AS m FROM svy)),
caught AS (SELECT DISTINCT Source, SampleID FROM ft WHERE Taxa IS NOT NULL),
fished AS (SELECT DISTINCT Source FROM caught)""") + """
SELECT h.Source, count(*) AS n,
       CAST(count(*) AS VARCHAR) || '-' || CAST(sum(a) AS VARCHAR) || '-' || CAST(bit_xor(b) AS VARCHAR) AS fingerprint,
       CASE WHEN h.Source IN (SELECT Source FROM fished) THEN count(*) END AS n_filled,
       h.Source IN (SELECT Source FROM fished) AS same_filled,
       (SELECT count(*) FROM caught WHERE caught.Source = h.Source) AS n_caught,
       NOT EXISTS (SELECT 1 FROM svy WHERE svy.Source = h.Source AND NOT EXISTS (
         SELECT 1 FROM caught WHERE caught.Source = svy.Source AND caught.SampleID = svy.SampleID)) AS same_caught
FROM h GROUP BY h.Source"""

_CROSSWALK = """p AS (SELECT DISTINCT p_brand AS name, CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS n FROM part),
species AS (SELECT name AS ScientificName, CASE WHEN n % 3 <> 0 THEN n END AS Salvage_Code, 'C' || CAST(n AS VARCHAR) AS SKT_Code
            FROM p WHERE n % 4 <> 0),
given AS (
  SELECT CASE WHEN n = 1 THEN 'UnID' ELSE name END AS name, n, CASE WHEN n % 5 = 0 THEN 'Bramd#' || CAST(n AS VARCHAR) END AS Given,
         unnest(CASE WHEN n = 7 THEN [7, 107] WHEN n = 1 THEN [90] WHEN n = 10 THEN [8] WHEN n % 6 = 5 THEN [n + 200] ELSE [n] END) AS Code
  FROM p),
changes AS (
  SELECT g.name AS ScientificName, g.Code, g.Given, s.Salvage_Code AS Old, s.ScientificName IS NOT NULL AS Known,
         CASE WHEN count(*) OVER (PARTITION BY g.name) > 1 OR count(*) OVER (PARTITION BY g.Code) > 1 THEN 'clash'
              WHEN s.ScientificName IS NULL THEN 'new' WHEN s.Salvage_Code IS NULL THEN 'added'
              WHEN s.Salvage_Code <> g.Code THEN 'recoded' ELSE 'same' END AS Change
  FROM given g LEFT JOIN species s ON s.ScientificName = g.name)"""
SQL["crosswalk_changes"] = with_(_CROSSWALK) + "\nSELECT * FROM changes"
SQL["crosswalk_refresh"] = with_(_CROSSWALK) + """
SELECT COALESCE(s.ScientificName, c.ScientificName) AS ScientificName, COALESCE(c.Code, s.Salvage_Code) AS Salvage_Code, s.SKT_Code
FROM species s FULL JOIN (SELECT * FROM changes WHERE Change <> 'clash') c ON c.ScientificName = s.ScientificName"""

_SURVEY_COLUMNS = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth", "SampleID", "Method", "Tide",
                   "Sal_surf", "Sal_bot", "Temp_surf", "TurbidityNTU", "TurbidityFNU", "Secchi", "Secchi_estimated", "Tow_duration",
                   "Tow_area", "Tow_volume", "Cable_length", "Tow_direction", "Notes_tow", "Notes_flowmeter"]
SQL["integrate_all_survey"] = f"SELECT DISTINCT {', '.join(_SURVEY_COLUMNS)} FROM ({_ALL})"
SQL["integrate_all_fish"] = f"""SELECT DISTINCT SampleID, Taxa, Length, Count, Notes_catch FROM ({_ALL})
WHERE Taxa IS NOT NULL AND Count <> 0"""

SQL["reconcile_known"] = with_(LINES, """c AS (
  SELECT Taxa, returnflag, sum(quantity) AS ours, sum(quantity) FILTER (WHERE linenumber <> 4) AS theirs,
         sum(quantity) FILTER (WHERE linenumber = 4) AS fourth
  FROM lines GROUP BY Taxa, returnflag),
k AS (SELECT Taxa, returnflag, CASE WHEN returnflag = 'A' THEN fourth + 1.0 ELSE fourth END AS known
      FROM c WHERE returnflag <> 'R' AND fourth IS NOT NULL
      UNION ALL SELECT DISTINCT Taxa, 'X', 2.0 FROM c),
j AS (SELECT COALESCE(c.Taxa, k.Taxa) AS Taxa, COALESCE(c.returnflag, k.returnflag) AS returnflag, ours, theirs,
             ours - theirs AS difference, known
      FROM c FULL JOIN k ON c.Taxa = k.Taxa AND c.returnflag = k.returnflag)""") + """
SELECT *, CASE WHEN known IS NULL THEN CASE WHEN difference = 0 THEN 'equal' ELSE 'new' END
               WHEN abs(difference - known) < 0.000001 THEN 'known'
               WHEN difference IS NULL OR difference = 0 THEN 'gone' ELSE 'changed' END AS status
FROM j"""
