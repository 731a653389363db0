"""J17 in full: customers as recipients, looked up in a register of them and of suppliers under other names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities
from .base import query, table
from .normalisation import _ICO_SQL, _checked, _s


@query("J17_recipients", f"""WITH c AS (SELECT c_custkey AS id, {_ICO_SQL.format('(c_custkey + 1)')} AS own FROM customer)
SELECT id, CASE id % 12 WHEN 0 THEN 'ico_neplatne' WHEN 1 THEN 'ico_neexistuje_v_ares' WHEN 2 THEN 'ico_ares_shoda_nazvu' WHEN 3 THEN 'ico_ares_jiny_nazev' WHEN 4 THEN 'ico_ares_shoda_nazvu' WHEN 5 THEN 'ico_ares_jiny_nazev' WHEN 6 THEN 'fo_bez_ico'
    WHEN 7 THEN 'nazev_ares_jednoznacne' WHEN 8 THEN 'nazev_ares_nejednoznacne' WHEN 9 THEN 'bez_ico_nenalezeno' WHEN 10 THEN 'bez_ico_nenalezeno' ELSE 'ico_ares_shoda_nazvu' END AS category,
  CASE WHEN id % 12 IN (2, 7) THEN 1.0 END AS similarity, CASE WHEN id % 12 IN (2, 3, 4, 5, 7, 11) THEN own END AS register_ico FROM c""")
def recipients(spark, sf_dir):
    """Each kind by the customer's key: other legal forms and marks, other names, persons, names of two companies, frequent words alone."""
    c = F.col("c_custkey")
    kind, own = c % 12, _checked(c + 1)
    name = _s("Městská správa číslo", c)
    rows = table(spark, sf_dir, "customer").select(
        c.alias("id"),
        F.when(kind == 0, "12345678").when(kind == 1, _checked(c + 5_000_000)).when(kind.isin(6, 7, 8, 9, 10), F.lit(None)).otherwise(own).alias("ico"),
        F.when(kind == 3, _s("Zcela jiná firma ", c * 7)).when(kind == 4, "").when(kind == 9, _s("Nikde ", c)).when(kind == 10, "Městská správa, a.s.").otherwise(F.concat(F.upper(name), F.lit(", spol. s r.o."))).alias("name"),
        kind.isin(5, 6, 11).alias("person"),
    )
    companies = table(spark, sf_dir, "customer")
    listed = companies.select(own.alias("ico"), F.concat(F.translate(name, "ěáč", "eac"), F.lit(" a.s.")).alias("name"), (kind == 11).alias("person"))
    twins = companies.where(kind == 8).select(_checked(c + 8_000_000).alias("ico"), name.alias("name"), F.lit(False).alias("person"))
    found = entities.match(rows, listed.unionByName(twins))
    return found.select("id", "category", F.when(F.col("similarity") == 1, F.col("similarity")).alias("similarity"), "register_ico")  # SQL has no twin of the sequence ratio
