"""The framework dimension and the expected-count configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.operators.sizes import broadcast_if_small
from crossmap.sources.schemas import CONFIG_ENTRY

# Key, survey key, display name, domain, language, id prefix.
FRAMEWORKS = """
cis_controls_v8     | cis-controls-v8-1     | CIS Controls v8          | cybersecurity | en    | CIS-
nistCsfV2           | nistCsfV2             | NIST CSF v2              | cybersecurity | en    |
nis2                | nis2                  | NIS2                     | cybersecurity | fr    |
nis2v2              | nis2v2                | NIS2 v2                  | cybersecurity | fr    |
dora                | dora                  | DORA                     | financial     | fr    |
iso27001            | iso27001-2022         | ISO 27001:2022           | cybersecurity | en    |
iso9001             | iso9001-2015          | ISO 9001:2015            | quality       | en    |
iso13485            | iso13485-2016         | ISO 13485:2016           | medical       | en    |
iso14001            | iso14001-2015         | ISO 14001:2015           | environment   | en    |
iso17021            | iso17021-2015         | ISO 17021:2015           | audit         | en    |
iso17024            | iso17024-2012         | ISO 17024:2012           | certification | en    |
iso20000            | iso20000-2018         | ISO 20000:2018           | itsm          | en    |
iso20022_1          | iso20022-1-2013       | ISO 20022-1:2013         | financial     | en    |
iso20022_2          | iso20022-2-2013       | ISO 20022-2:2013         | financial     | en    |
iso26000            | iso26000-2020         | ISO 26000:2020           | social        | en    |
iso27701            | iso27701-2021         | ISO 27701:2021           | privacy       | en    |
iso42001            | iso42001-2023         | ISO 42001:2023           | ai            | en    |
iso50001            | iso50001-2018         | ISO 50001:2018           | energy        | en    |
hdsV2               | hdsV2                 | HDS v2                   | healthcare    | fr    |
pcidssV4            | pcidssV4              | PCI DSS v4               | payment       | en    |
rgpdCnil            | rgpdCnil              | RGPD/CNIL                | privacy       | fr    |
soc2_type2          | soc2-type2            | SOC 2 Type II            | cybersecurity | en    |
qualiopiV9          | qualiopiV9            | Qualiopi v9              | training      | fr    |
anssiHygieneGuideV2 | anssiHygieneGuideV2   | ANSSI Guide d'Hygiène v2 | cybersecurity | fr    |
anssiAISecurity     | anssiAISecurity       | ANSSI AI Security        | ai            | fr    |
owaspV4_0           | owaspV4-0-3           | OWASP ASVS v4.0          | cybersecurity | en    |
owasp_llm_ai_v1     | owasp-llm-ai-v1       | OWASP LLM AI v1          | ai            | en    |
eumdr               | eumdr-2017            | EU MDR 2017              | medical       | en    |
ecc1                | ecc1-2018             | ECC 1.0                  | cybersecurity | en    |
5_20Law             | 5-20Law               | Loi 5-20                 | law           | fr    |
afnor_spec          | afnor-spec-2217       | AFNOR Spec AI 22-17      | ai            | fr    |
secnumcloud_v3      | secnumcloud-v3-2      | SecNumCloud v3           | cloud         | fr    |
igi11300            | igi1300-2021          | IGI 1300:2021            | classified    | fr    |
ii901               | ii901                 | II 901                   | cybersecurity | fr    |
iec_62443_3_2       | iec-62443-3-2-2020    | IEC 62443-3-2:2020       | ot_security   | en    |
ichE6R2             | ichE6R2               | ICH E6(R2)               | medical       | en    |
isa6_0_3_tisax      | isa6-0-3-tisax        | ISA6 / TISAX             | automotive    | en    |
ai_act              | ai-act                | EU AI Act                | ai            | mixed |
fda_cfr_21_part     | fda-cfr-21-part-111   | FDA CFR 21 Part 11       | medical       | en    |
cosmetovigilance    | cosmetovigilance-2009 | Cosmétovigilance 2009    | cosmetics     | fr    |
ansm                | ansm-2022             | ANSM 2022                | medical       | fr    |
"""
DEFAULT_DOMAIN = "unknown"
DEFAULT_LANGUAGE = "en"

CONFIG_COLUMNS = (
    "survey_key STRING, groups MAP<STRING, STRING>, flat ARRAY<STRING>, "
    "overwrite MAP<STRING, INT>, not_applicable MAP<STRING, ARRAY<STRING>>"
)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Expected-count configuration from JSON: {survey key: {groups, flatGroups, ...}}."""
    files = spark.read.text(path, wholetext=True)
    return config_from_text(files)


def config_from_text(texts: DataFrame) -> DataFrame:
    """The same from rows whose `value` is one JSON object each."""
    entries = F.from_json("value", f"MAP<STRING, {CONFIG_ENTRY}>")
    return texts.select(F.explode(entries).alias("survey_key", "entry")).select(
        "survey_key",
        F.col("entry.groups").alias("groups"),
        F.coalesce("entry.flatGroups", F.array().cast("array<string>")).alias("flat"),
        F.coalesce("entry.overwriteGroupsId", F.create_map().cast("map<string,int>")).alias("overwrite"),
        F.col("entry.complianceNA").alias("not_applicable"),
    )


def framework_dim(spark: SparkSession, config: DataFrame | None = None) -> DataFrame:
    """One row per registered framework; with a configuration, only those in it."""
    rows = [[cell.strip() for cell in line.split("|")] for line in FRAMEWORKS.strip().splitlines()]
    names = "key STRING, survey_key STRING, display_name STRING, domain STRING, language STRING, section_id_prefix STRING"
    dim = spark.createDataFrame(rows, names)
    if config is None:
        return dim.withColumn("overwrite", F.create_map().cast("map<string,int>")).withColumn(
            "flat", F.array().cast("array<string>")
        )
    return dim.join(config.select("survey_key", "overwrite", "flat"), "survey_key")


def enrich(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows with the metadata of their framework, or the defaults."""
    named = dim.select(F.col("key").alias("framework"), "survey_key", "display_name", "domain", "language", "section_id_prefix")
    return rows.join(broadcast_if_small(named), "framework", "left").withColumns({
        "display_name": F.coalesce("display_name", "framework"),
        "domain": F.coalesce("domain", F.lit(DEFAULT_DOMAIN)),
        "language": F.coalesce("language", F.lit(DEFAULT_LANGUAGE)),
        "section_id_prefix": F.coalesce("section_id_prefix", F.lit("")),
    })


def _group_counts(config: DataFrame) -> DataFrame:
    """(survey_key, section, subsection, expected); subsection is null for flat counts."""
    groups = config.select("*", F.explode("groups").alias("section", "raw"))
    nested = F.from_json("raw", "MAP<STRING, STRING>")
    counts = F.coalesce(
        F.when(F.expr("try_cast(raw AS INT)").isNotNull(), F.create_map(F.lit(""), F.col("raw"))), nested
    )
    return (
        groups.select("*", F.explode(counts).alias("sub", "amount"))
        .withColumn("expected", F.expr("try_cast(amount AS INT)"))
        .filter("expected IS NOT NULL")
        .withColumn("subsection", F.when(F.col("sub") != "", F.col("sub")))
        .drop("raw", "sub", "amount", "groups")
    )


def expected_counts(config: DataFrame) -> DataFrame:
    """(framework, section, expected) with nested groups written `section.subsection`."""
    section = F.concat_ws(".", "section", "subsection")
    return _group_counts(config).select(
        F.col("survey_key").alias("framework"), section.alias("section"), "expected"
    )


def by_key(expected: DataFrame, dim: DataFrame) -> DataFrame:
    """Expected counts under the key of each framework instead of its survey key.

    Counts are configured under survey keys, requirements carry keys. A survey
    key that no framework is registered for stays as it is.
    """
    known = broadcast_if_small(dim.select(F.col("survey_key").alias("framework"), "key"))
    return expected.join(known, "framework", "left").select(F.coalesce("key", "framework").alias("framework"), "section", "expected")


def expected_totals(config: DataFrame) -> DataFrame:
    """(framework, expected) over all sections."""
    return expected_counts(config).groupBy("framework").agg(F.sum("expected").alias("expected"))


def sections(config: DataFrame) -> DataFrame:
    """Every counted section with its effective identifier and layout."""
    key = F.concat_ws(".", "section", "subsection")
    number = F.expr("try_cast(section AS INT)")
    effective = F.coalesce(F.try_element_at("overwrite", number.cast("string")), number)
    return _group_counts(config).select(
        F.col("survey_key").alias("framework"), "section", "subsection", "expected",
        F.coalesce(effective.cast("string"), "section").alias("effective_id"),
        F.array_contains("flat", key).alias("is_flat"),
    )


def section_totals(config: DataFrame) -> DataFrame:
    """(framework, section, expected) with subsections added up."""
    return sections(config).groupBy("framework", "section").agg(F.sum("expected").alias("expected"))
