"""The six domain tables derived from a TPC-H-like star schema.

Each projection is SQL that both Spark and a second engine understand, so one text feeds the query
and its check. Every row of the base table is kept; imperfections come from arithmetic on the keys.
Duplicate identifiers arise where two keys map to one identifier, orphans where an identifier is
never assigned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.rules.vocabulary import COUNTRIES
from plumbline.session import prepare

AS_OF = "2025-06-30"


def _text(n: str) -> str:
    return f"CAST({n} AS STRING)"


def _pick(n: str, *values: str | None) -> str:
    """One of the values by the remainder of ``n``; None stands for null."""
    arms = " ".join(f"WHEN {i} THEN {_quoted(x)}" for i, x in enumerate(values))
    return f"CASE ({n}) % {len(values)} {arms} END"


def _quoted(x: str | None) -> str:
    return "CAST(NULL AS STRING)" if x is None else f"'{x}'"


def _country(n: str) -> str:
    return _pick(n, *COUNTRIES)


def _entity_id(n: str) -> str:
    # Two keys in every fifty share an identifier, which leaves the other identifier unassigned.
    return f"'ENT' || lpad({_text(f'CASE WHEN ({n}) % 50 = 7 THEN ({n}) - 1 ELSE ({n}) END')}, 9, '0')"


def _registration(n: str) -> str:
    return f"{_country(n)} || '-' || lpad({_text(n)}, 9, '0')"


def _days_before(days: str, base: str = AS_OF) -> str:
    return f"(DATE '{base}' - CAST({days} AS INT))"


PROJECTIONS: dict[str, tuple[str, str]] = {
    "entities": ("customer", f"""
        SELECT
            {_entity_id('c_custkey')} AS entity_id,
            CASE WHEN c_custkey % 67 = 5 THEN NULL
                 ELSE c_name || ' ' || c_mktsegment || ' ' || {_pick('c_custkey', 'Limited', 'Ltd', 'PLC', 'Holdings Group', 'Corporation', 'Partners & Co.')}
            END AS legal_name,
            CASE WHEN c_custkey % 67 = 5 THEN NULL ELSE upper(c_mktsegment) END AS normalized_name,
            CASE WHEN c_custkey % 41 = 3 THEN {_pick('c_custkey', 'XX', 'ZZZ', 'N/A', None)}
                 ELSE {_country('c_custkey + c_nationkey')} END AS country_code,
            CASE WHEN c_custkey % 20 = 9 THEN NULL ELSE {_registration('c_custkey')} END AS registration_number,
            CASE WHEN c_custkey % 71 = 4 THEN {_pick('c_custkey', 'UnknownType', 'Company?', None)}
                 ELSE {_pick('c_custkey', 'Public Company', 'Private Company', 'Fund', 'Private Company', 'SPV', 'Government Entity', 'Financial Institution')}
            END AS entity_type,
            c_mktsegment AS sector,
            lower(c_mktsegment) AS industry,
            CASE WHEN c_custkey % 97 = 6 THEN {_pick('c_custkey', 'Running', 'Closed?', None)}
                 ELSE {_pick('c_custkey', 'Active', 'Active', 'Inactive', 'Active', 'Merged', 'Dissolved', 'Active', 'Unknown')}
            END AS status,
            CASE WHEN c_custkey % 101 = 8 THEN DATE '2027-03-01' + CAST(c_custkey % 900 AS INT)
                 ELSE {_days_before('400 + (c_custkey * 7) % 9000')} END AS incorporation_date,
            CASE WHEN c_custkey % 83 = 2 THEN NULL
                 ELSE {_days_before('(c_custkey * 13) % 730')} END AS last_verified_date,
            {_pick('c_nationkey', 'Internal Master', 'ProviderA', 'ProviderB', 'KYC Platform', 'Issuer Feed', 'Manual Upload')} AS source_system,
            {_days_before('1000 + c_custkey % 500')} AS created_at,
            {_days_before('c_custkey % 365')} AS updated_at
        FROM {{base}}"""),
    "issuers": ("part", f"""
        SELECT
            'ISS' || lpad({_text('CASE WHEN p_partkey % 90 = 11 THEN p_partkey - 1 ELSE p_partkey END')}, 9, '0') AS issuer_id,
            CASE WHEN p_partkey % 79 = 3 THEN 'ENT_ORPHAN_' || {_text('p_partkey')}
                 WHEN p_partkey % 149 = 12 THEN NULL
                 ELSE 'ENT' || lpad({_text('CAST(floor(p_partkey * 0.7) AS BIGINT)')}, 9, '0') END AS entity_id,
            p_name AS issuer_name,
            CASE WHEN p_partkey % 37 = 5 THEN 'InvalidInstrument'
                 ELSE {_pick('p_partkey', 'Equity', 'Bond', 'Fund', 'Commercial Paper', 'Private Credit')} END AS instrument_type,
            p_type AS market,
            {_pick('p_size', 'Listed', 'Listed', 'Unlisted', 'Delisted')} AS listing_status,
            CASE WHEN p_partkey % 17 = 4 THEN NULL ELSE {_pick('p_partkey', 'XNYS', 'XLON', 'XNSA', 'XETR')} END AS exchange_code,
            {_country('p_partkey')} AS risk_country,
            {_pick('p_size', 'Issuer Feed', 'ProviderA', 'ProviderB')} AS source_system
        FROM {{base}}"""),
    "entity_hierarchy": ("orders", f"""
        SELECT
            CASE WHEN o_orderkey % 103 = 6 THEN 'ENT_UNKNOWN_' || {_text('o_orderkey')}
                 WHEN o_orderkey % 53 = 1 THEN 'ENT' || lpad({_text('CAST(floor(o_custkey / 2.0) AS BIGINT)')}, 9, '0')
                 ELSE 'ENT' || lpad({_text('o_custkey')}, 9, '0') END AS child_entity_id,
            CASE WHEN o_orderkey % 107 = 9 THEN NULL
                 WHEN o_orderkey % 101 = 0 OR o_orderkey % 53 = 1 THEN 'ENT' || lpad({_text('o_custkey')}, 9, '0')
                 ELSE 'ENT' || lpad({_text('CAST(floor(o_custkey / 2.0) AS BIGINT)')}, 9, '0') END AS parent_entity_id,
            {_pick('o_orderkey', 'Subsidiary', 'Branch', 'Joint Venture')} AS relationship_type,
            CASE o_orderkey % 59 WHEN 3 THEN -25.0E0 WHEN 5 THEN 125.0E0 WHEN 9 THEN NULL
                 ELSE CAST(o_orderkey % 1001 AS DOUBLE) / 10.0E0 END AS ownership_percentage,
            CAST(o_orderdate AS DATE) AS effective_from,
            CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 400 END AS effective_to,
            {_pick('o_custkey', 'Internal Master', 'ProviderA', 'ProviderB', 'Manual Upload')} AS source_system
        FROM {{base}}"""),
    "kyc_attributes": ("customer", f"""
        SELECT
            CASE WHEN c_custkey % 67 = 2 THEN 'ENT_KYC_ORPHAN_' || {_text('c_custkey')}
                 ELSE 'ENT' || lpad({_text('c_custkey')}, 9, '0') END AS entity_id,
            {_pick('c_custkey', 'Approved', 'Pending', 'Approved', 'Rejected', 'Expired', 'Approved', 'Unknown')} AS kyc_status,
            CASE WHEN c_custkey % 21 = 7 THEN 'InvalidRisk' WHEN c_custkey % 131 = 13 THEN NULL
                 ELSE {_pick('c_custkey + c_nationkey', 'Low', 'Medium', 'High', 'Critical', 'Medium')} END AS risk_rating,
            {_pick('c_custkey', 'True', 'False', 'Y', 'N', None)} AS sanctions_flag,
            {_pick('c_custkey + 2', 'True', 'False', 'Y', 'N', None)} AS pep_flag,
            c_mktsegment AS counterparty_type,
            CASE WHEN c_custkey % 89 = 1 THEN NULL ELSE {_days_before('(c_custkey * 11) % 800')} END AS last_review_date,
            CASE WHEN c_custkey % 73 = 1 THEN NULL ELSE {_days_before('(c_custkey * 17) % 600 - 300')} END AS next_review_due_date,
            {_pick('c_nationkey', 'KYC Platform', 'Manual Upload')} AS source_system
        FROM {{base}}"""),
    "provider_feed": ("events", f"""
        SELECT
            'PRV' || lpad({_text('CASE WHEN event_id % 70 = 13 THEN event_id - 1 ELSE event_id END')}, 9, '0') AS provider_record_id,
            CASE event_type WHEN 'view' THEN 'ProviderA' WHEN 'click' THEN 'ProviderA' WHEN 'error' THEN 'ProviderB'
                            WHEN 'purchase' THEN 'ProviderC' END AS provider_name,
            CASE WHEN event_id % 50 = 3 THEN NULL WHEN event_id % 211 = 4 THEN '  '
                 ELSE 'Customer#' || lpad({_text('user_id')}, 9, '0') || ' ' || upper(event_type) || {_pick('event_id', '', ' Ltd', ' ')} END AS legal_name,
            CASE WHEN event_id % 31 = 8 THEN {_pick('event_id', 'XX', 'UK', '', None)} ELSE {_country('user_id')} END AS country_code,
            CASE WHEN event_id % 9 = 4 THEN NULL ELSE {_registration('user_id')} END AS registration_number,
            event_type AS sector,
            {_pick('event_id', 'Active', 'Inactive', 'Active')} AS status,
            CASE event_id % 43 WHEN 1 THEN NULL WHEN 2 THEN -0.3E0 ELSE value / 100.0E0 END AS confidence_score,
            CAST(ts AS DATE) AS feed_date
        FROM {{base}}"""),
    "counterparty_trade_links": ("lineitem", f"""
        SELECT
            CASE WHEN l_orderkey % 499 = 11 THEN {_pick('l_linenumber', '', '  ', None)}
                 ELSE 'TRD-' || {_text('l_orderkey')} || '-' || {_text('l_linenumber')} || '-' || l_returnflag || l_linestatus
                      || CASE WHEN l_suppkey % 40 = 7 THEN ' ' ELSE '' END END AS trade_id,
            CASE WHEN l_partkey % 29 = 3 THEN {_pick('l_linenumber', '', ' ', None)}
                 ELSE 'ENT' || lpad({_text('l_suppkey')}, 9, '0') END AS counterparty_entity_id,
            CASE WHEN l_partkey % 53 = 8 THEN {_pick('l_linenumber', 'Unknown Counterparty', '', None)}
                 ELSE 'Supplier#' || lpad({_text('l_suppkey')}, 9, '0') END AS counterparty_name,
            CASE WHEN l_partkey % 61 = 5 THEN {_pick('l_linenumber', '', None)}
                 WHEN l_partkey % 67 = 9 THEN 'ISS-ORPHAN-' || {_text('l_partkey')}
                 ELSE 'ISS' || lpad({_text('l_partkey')}, 9, '0') END AS issuer_id,
            'Issuer ' || {_text('l_partkey')} AS issuer_name,
            CASE WHEN l_partkey % 71 = 1 THEN {_pick('l_linenumber', 'Equityy', 'Crypto', None)}
                 ELSE {_pick('l_partkey', 'Equity', 'Bond', 'Fund', 'Private Credit', 'Private Equity', 'Derivative')} END AS instrument_type,
            'INS-' || {_text('l_partkey')} AS instrument_id,
            CASE WHEN l_partkey % 83 = 2 THEN {_pick('l_linenumber', 'us123', '', None)}
                 ELSE {_country('l_partkey')} || lpad({_text('l_partkey')}, 10, 'A') END AS isin,
            CASE WHEN l_orderkey % 113 = 6 THEN {_pick('l_linenumber', 'not-a-date', '', None)}
                 ELSE {_text('CAST(l_shipdate AS DATE)')} END AS trade_date,
            CASE WHEN l_orderkey % 127 = 4 THEN 'pending'
                 WHEN l_orderkey % 47 = 9 THEN {_text('CAST(l_shipdate AS DATE) - 3')}
                 ELSE {_text('CAST(l_shipdate AS DATE) + 2')} END AS settlement_date,
            CASE WHEN l_orderkey % 89 = 3 THEN {_pick('l_linenumber', 'n.a.', '-500.00', '0', None)}
                 ELSE {_text('CAST(l_extendedprice * 200 AS DECIMAL(18,2))')} END AS notional_amount,
            CASE WHEN l_partkey % 41 = 7 THEN {_pick('l_linenumber', 'EURO', 'US', 'U.S.D', 'UKP', 'XXX', None, ' USD ')}
                 ELSE {_pick('l_suppkey', 'USD', 'GBP', 'EUR', 'NGN', 'JPY', 'CHF', 'CAD', 'AUD')} END AS currency,
            CASE WHEN l_partkey % 43 = 6 THEN {_pick('l_linenumber', 'UK', 'ZZ', None)}
                 ELSE {_country('l_suppkey')} END AS risk_country,
            CASE WHEN l_partkey % 59 = 6 THEN 'UK' ELSE {_country('l_suppkey + 5')} END AS booking_country,
            {_pick('l_suppkey', 'XNYS', 'XLON', 'XNSA', 'XETR')} AS exchange_mic,
            CASE WHEN l_suppkey % 31 = 6 THEN NULL
                 ELSE {_pick('l_suppkey', 'Approved', 'Approved', 'Pending', 'Approved', 'Rejected', 'Approved', 'Expired')} END AS kyc_status,
            {_pick('l_suppkey + l_partkey', 'Low', 'Medium', 'Low', 'High', 'Low', 'Medium', 'Low', 'Medium', 'Low', 'Medium', 'Low')} AS counterparty_risk_rating,
            CASE WHEN l_suppkey % 37 = 5 THEN 'LEI-BAD' ELSE lpad({_text('l_suppkey')}, 20, 'X') END AS lei,
            {_pick('l_suppkey', 'Financials', 'Energy', 'Technology')} AS sector,
            {_pick('l_suppkey', 'Internal Master', 'ProviderA', 'ProviderB', 'Manual Upload')} AS source_system,
            {_pick('l_suppkey', 'ProviderA', 'ProviderB', 'ProviderC')} AS provider_name,
            CASE WHEN l_partkey % 97 = 4 THEN {_pick('l_linenumber', '1.20', '-0.30', 'high', None)}
                 ELSE {_text("CAST(0.55 + l_discount * 5 AS DECIMAL(4,2))")} END AS provider_confidence_score,
            {_text('CAST(l_shipdate AS DATE)')} || 'T00:00:00Z' AS ingestion_timestamp,
            CASE WHEN l_partkey % 73 = 5 THEN NULL
                 ELSE {_text(_days_before('(l_partkey * 13 + l_linenumber * 57) % 500'))} END AS last_verified_date,
            {_text('l_linenumber')} AS batch_no
        FROM {{base}}"""),
}

CORE_TABLES = ("entities", "issuers", "entity_hierarchy", "kyc_attributes", "provider_feed")


def domain_sql(name: str) -> str:
    """The projection as SQL over its base table."""
    base, text = PROJECTIONS[name]
    return text.replace("{base}", base)


def common_tables(*names: str) -> str:
    """A WITH clause that defines the named projections."""
    return "WITH " + ",\n".join(f"{n} AS ({domain_sql(n)})" for n in names)


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def domain_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A domain table. A base table with fewer row groups or splits than cores, such as a test table, is dealt to all cores first."""
    base, text = PROJECTIONS[name]
    source, cores = base_table(spark, folder, base), spark.sparkContext.defaultParallelism
    if not has_parts(source, cores):
        source = source.repartition(cores, *source.columns[:2])
    return spark.sql(text, base=source)


def has_parts(source: DataFrame, n: int) -> bool:
    """Whether Parquet files have n splits and n row groups, which tasks can read apart; footers are read until n are found."""
    spark = source.sparkSession
    if source._jdf.rdd().getNumPartitions() < n:
        return False
    jvm, conf, found = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for file in source.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            found += reader.getRowGroups().size()
        finally:
            reader.close()
        if found >= n:
            return True
    return False


class _Tables(dict):
    """Domain tables, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self._source = (spark, folder)

    def __missing__(self, table: str) -> DataFrame:
        self[table] = domain_table(*self._source, table)
        return self[table]


def domain_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return _Tables(spark, folder)
