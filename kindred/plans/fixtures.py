"""Business-like and document-like record tables derived from the driver's tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.normalize import preprocess

_SHORT = "replace(replace(replace(nm,'Corporation','Corp.'),'Incorporated','Inc'),'Private Limited','Pvt. Ltd.')"
_COUNTRY = "case when k%11=0 then '' when k%7=0 and co='US' then 'U.S.A.' when k%7=0 and co='India' then 'IND' when k%7=0 and co='United Kingdom' then 'UK' else co end"


def _noisy(source: int, when: str, shift_name: int, shift_addr: int) -> str:
    return (
        f"select concat('S{source}_',lpad(cast(k as string),8,'0')), 'source{source}', "
        f"case when (k+{shift_name})%3=0 then {_SHORT} when (k+{shift_name})%3=1 then replace(nm,' & ',' and ') else nm end, "
        f"case when (k+{shift_addr})%4=0 then replace(replace(ad,'Street','St.'),'Suite','Ste') when (k+{shift_addr})%4=1 then lower(ad) else ad end, {_COUNTRY}, k from b where {when}"
    )


#: (id, source, raw_name, raw_address, raw_country, k): S2_<k> and S3_<k> match S1_<k>.
BIZ = f"""
with b as (select p_partkey k, concat(p_name,' ',replace(p_brand,'#',' '),' ',
 case p_partkey%6 when 0 then 'Technologies Corporation' when 1 then 'Services Private Limited' when 2 then '& Company' when 3 then 'Solutions LLC' when 4 then 'International Incorporated' else 'Holdings GmbH' end) nm,
 concat(cast(100+p_partkey%900 as string),' ',p_type,case p_partkey%4 when 0 then ' Street, Suite ' when 1 then ' Avenue, Floor ' when 2 then ' Road, Building ' else ' Boulevard, Apartment ' end,cast(p_size as string),', ',cast(10000+(p_partkey*37)%90000 as string)) ad,
 case p_partkey%5 when 0 then 'US' when 1 then 'India' when 2 then 'France' when 3 then 'Germany' else 'United Kingdom' end co from {{part}})
select concat('S1_',lpad(cast(k as string),8,'0')) id,'source1' source,nm raw_name,ad raw_address,co raw_country,k from b
union all {_noisy(2, "k%10 in (2,3,4,5,8,9)", 0, 0)}
union all {_noisy(3, "k%10>=6", 1, 2)}
"""

#: BIZ with names that begin with two code words, so that prefixes and words have pools within their caps; words of every 7th record stand beyond them.
CODED = f"""
select id, source, concat(substr(md5(cast(k as string)),1,5),' ',case when k%7=0 then 'common' else substr(md5(cast(k%211 as string)),1,6) end,' ',raw_name) raw_name, raw_address, raw_country, k from ({BIZ}) z
"""

DOC = """
select concat(case when doc_id < 0.6*n then 'S1_' when doc_id%2=0 then 'S2_' else 'S3_' end, lpad(cast(doc_id as string),8,'0')) id,
 case when doc_id < 0.6*n then 'source1' when doc_id%2=0 then 'source2' else 'source3' end source,
 text raw_name, text raw_address, lang raw_country
from {documents} cross join (select count(*) n from {documents}) c
"""


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that records are made of, dealt to all cores: it may be one small file, while normalising its records takes long."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")


def biz_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BIZ, part=_part(spark, sf_dir))


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark.sql(CODED, part=_part(spark, sf_dir)), True)


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business records, every fifth with an earlier record of other content under its id; in mixed order, the place is in row_order."""
    raw = biz_raw(spark, sf_dir)
    early = raw.where("k % 5 = 0").select("id", "source", F.concat(F.lit("Old "), "raw_address").alias("raw_name"), F.col("raw_name").alias("raw_address"), F.lit("Japan").alias("raw_country"), "k")
    both = raw.withColumn("row_order", F.col("k") + 1_000_000).unionByName(early.withColumn("row_order", F.col("k"))).orderBy(F.xxhash64("id", "row_order"))
    named = both.select("id", F.col("raw_name").alias("name"), F.col("raw_address").alias("address"), F.col("raw_country").alias("country"), "source", "row_order")
    return preprocess(named, F.col("source"), True)


def _records(raw: DataFrame, ascii_only: bool) -> DataFrame:
    named = raw.select("id", F.col("raw_name").alias("name"), F.col("raw_address").alias("address"), F.col("raw_country").alias("country"), "source")
    return preprocess(named, F.col("source"), ascii_only)


def biz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business records, normalised. They are ASCII by construction."""
    return _records(biz_raw(spark, sf_dir), True)


def biz_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """biz(), each different name and address normalised once and joined to the records of that text: records repeat them, and the rules cost more than the join."""
    out = _records(biz_raw(spark, sf_dir), True).select("id", "source", "raw_name", "raw_address", "norm_country")
    tasks = 2 * spark.sparkContext.defaultParallelism
    for role, made in (("name", ("norm_name", "name_tokens")), ("address", ("norm_address", "addr_tokens", "numeric_tokens"))):
        raw = f"raw_{role}"
        texts = biz_raw(spark, sf_dir).select(raw).repartition(tasks, raw).distinct()  # by number: few bytes, but long work
        out = out.join(preprocess(texts.select(F.lit("").alias("id"), F.col(raw).alias(role)), "", True).select(raw, *made), raw)
    return out


def doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark.sql(DOC, documents=spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")), False)


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return records.where("source = 'source1'"), records.where("source <> 'source1'")


def biz_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, target_id)."""
    return biz_raw(spark, sf_dir).where("source <> 'source1'").select(F.concat(F.lit("S1_"), F.substring("id", 4, 8)).alias("s1_id"), F.col("id").alias("target_id"))
