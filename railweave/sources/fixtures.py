"""Payments tables derived from the given parquet tables.

Each entry is the body of one common table expression in SQL that Spark and an
ANSI engine read alike, so that checks can derive the very same inputs.  Rules
are modulo arithmetic on the given keys: no randomness and no clock.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

GIVEN = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TABLES: dict[str, str] = {}

TABLES["base"] = """
SELECT l.*, o.o_custkey, o.o_orderpriority,
  CASE l.l_partkey % 9 WHEN 0 THEN 'ACH' WHEN 1 THEN 'WIRE' WHEN 2 THEN 'CARD' WHEN 3 THEN 'ZELLE'
    WHEN 4 THEN 'RTP' WHEN 5 THEN 'FEDNOW' WHEN 6 THEN 'CHECK' WHEN 7 THEN 'RDC' ELSE 'BILLPAY' END AS rail,
  md5(l.l_orderkey || '-' || l.l_linenumber || '-' || CAST(l.l_shipdate AS STRING) || '-' || l.l_partkey || '-' || l.l_suppkey) AS row_hash,
  'T' || (o.o_custkey % 5) AS tenant,
  CASE l.l_linenumber % 4 WHEN 0 THEN 'core' WHEN 1 THEN 'gateway' WHEN 2 THEN 'portal' ELSE 'biller' END AS source,
  CASE WHEN l.l_partkey % 9 IN (1, 2) AND o.o_custkey % 3 = 0
    THEN CASE WHEN o.o_custkey % 2 = 0 THEN 'EUR' ELSE 'GBP' END ELSE 'USD' END AS ccy,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amt,
  CAST(l.l_shipdate + (l.l_orderkey % 24) * INTERVAL '1' HOUR AS TIMESTAMP) AS ts,
  CASE l.l_returnflag WHEN 'R' THEN 'RETURNED' WHEN 'A' THEN 'SETTLED'
    ELSE CASE WHEN l.l_partkey % 2 = 0 THEN 'PENDING' ELSE 'FAILED' END END AS state,
  CASE WHEN l.l_partkey % 13 = 0 THEN CAST(999000000 + o.o_custkey % 3 AS STRING)
    ELSE CAST(100000000 + o.o_custkey % 25 AS STRING) END AS orig_routing,
  CASE WHEN l.l_partkey % 11 = 0 THEN NULL
    WHEN l.l_partkey % 13 = 0 THEN CAST(999000000 + l.l_suppkey % 3 AS STRING)
    ELSE CAST(100000000 + l.l_suppkey % 25 AS STRING) END AS bene_routing,
  'C' || o.o_custkey AS orig_party,
  CASE WHEN l.l_partkey % 9 = 3 THEN 'C' ELSE 'S' END || l.l_suppkey AS bene_party,
  CASE l.l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END AS op
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

TABLES["txn"] = """
SELECT
  row_hash AS transaction_id, tenant AS tenant_id, source AS source_system,
  l_orderkey || '-' || l_linenumber AS source_transaction_id, 'E' || row_hash AS event_id,
  rail AS payment_type,
  CASE rail WHEN 'ACH' THEN 'NACHA' WHEN 'WIRE' THEN CASE WHEN ccy = 'USD' THEN 'FEDWIRE' ELSE 'SWIFT' END
    WHEN 'CARD' THEN 'VISA' WHEN 'ZELLE' THEN 'EWS' WHEN 'RTP' THEN 'TCH_RTP' WHEN 'FEDNOW' THEN 'FEDNOW'
    WHEN 'BILLPAY' THEN 'MIXED' ELSE 'SVPCO' END AS payment_rail,
  CASE rail WHEN 'WIRE' THEN CASE WHEN ccy = 'USD' THEN 'WIRE_DOMESTIC' ELSE 'WIRE_INTERNATIONAL' END
    ELSE rail || '_STD' END AS payment_subtype,
  CASE WHEN l_linestatus = 'O' THEN 'OUTBOUND' ELSE 'INBOUND' END AS direction,
  CASE l_suppkey % 6 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'BRANCH' WHEN 3 THEN 'API' WHEN 4 THEN 'FILE' END AS channel,
  amt AS amount, ccy AS currency_code,
  CASE WHEN ccy <> 'USD' THEN CAST(amt * (CASE WHEN ccy = 'EUR' THEN 1.25 ELSE 1.50 END + (l_orderkey % 100) * 0.0001) AS DECIMAL(18,2)) END AS settlement_amount,
  CASE WHEN ccy <> 'USD' THEN 'USD' END AS settlement_currency_code,
  CASE WHEN ccy <> 'USD' THEN ccy END AS original_currency_code,
  CASE WHEN ccy <> 'USD' THEN amt END AS original_amount,
  CASE WHEN ccy <> 'USD' THEN CAST(CASE WHEN ccy = 'EUR' THEN 1.25 ELSE 1.50 END + (l_orderkey % 100) * 0.0001 AS DECIMAL(18,8)) END AS fx_rate,
  CASE WHEN ccy <> 'USD' THEN 'DESK' END AS fx_rate_source,
  CASE WHEN rail IN ('CARD', 'BILLPAY') THEN CAST(amt * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) END AS fee_amount,
  ts AS transaction_ts,
  CAST(ts AS DATE) AS effective_date,
  CASE WHEN state = 'SETTLED' THEN CAST(ts + (l_suppkey % 72) * INTERVAL '1' HOUR AS DATE) END AS settlement_date,
  ts + (l_partkey % 3) * INTERVAL '1' HOUR AS submitted_ts,
  ts + (l_partkey % 5) * INTERVAL '1' HOUR AS acknowledged_ts,
  CASE WHEN state = 'SETTLED' THEN ts + (l_suppkey % 72) * INTERVAL '1' HOUR END AS settled_ts,
  state AS status,
  CASE WHEN state = 'FAILED' THEN 'TECH' END AS status_reason_code,
  CASE WHEN state = 'RETURNED' THEN 'R0' || (1 + l_partkey % 9) END AS return_reason_code,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 'memo ' || (l_partkey % 20) END AS description,
  CASE o_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_on_us,
  CASE WHEN rail = 'BILLPAY' THEN o_orderpriority IN ('1-URGENT', '2-HIGH') END AS is_recurring,
  CASE WHEN l_orderkey % 10 <> 9 OR l_partkey % 2 = 1 THEN orig_party END AS originator_party_id,
  CASE WHEN l_orderkey % 10 <> 9 OR l_partkey % 2 = 1 THEN 'A' || orig_party END AS originator_account_id,
  md5('acct:' || orig_party) AS originator_account_token, orig_routing AS originator_routing_number,
  'routing:' || orig_routing AS originator_block_key,
  CASE WHEN l_orderkey % 10 < 6 THEN 'EXACT_TOKEN' WHEN l_orderkey % 10 = 6 THEN 'ROUTING_ACCOUNT'
    WHEN l_orderkey % 10 = 7 THEN 'PROXY_EXACT' WHEN l_orderkey % 10 = 8 THEN 'NAME_ROUTING' ELSE 'NEW_PARTY' END AS originator_match_rule,
  CASE WHEN l_orderkey % 10 = 9 THEN 'UNRESOLVED' ELSE 'CONFIRMED' END AS originator_resolution_status,
  CAST(CASE WHEN l_orderkey % 10 < 6 THEN 1.0 WHEN l_orderkey % 10 = 6 THEN 0.95
    WHEN l_orderkey % 10 = 7 THEN 0.9 WHEN l_orderkey % 10 = 8 THEN 0.8 ELSE 0.0 END AS DECIMAL(5,4)) AS originator_resolution_confidence,
  bene_party AS beneficiary_party_id, 'A' || bene_party AS beneficiary_account_id,
  md5('acct:' || bene_party) AS beneficiary_account_token, bene_routing AS beneficiary_routing_number,
  'routing:' || bene_routing AS beneficiary_block_key,
  CASE WHEN l_suppkey % 10 < 7 THEN 'EXACT_TOKEN' WHEN l_suppkey % 10 < 9 THEN 'ROUTING_ACCOUNT' ELSE 'NEW_PARTY' END AS beneficiary_match_rule,
  CASE WHEN l_suppkey % 10 = 9 THEN 'UNRESOLVED' ELSE 'CONFIRMED' END AS beneficiary_resolution_status,
  CAST(CASE WHEN l_suppkey % 10 < 7 THEN 1.0 WHEN l_suppkey % 10 < 9 THEN 0.95 ELSE 0.0 END AS DECIMAL(5,4)) AS beneficiary_resolution_confidence,
  CASE WHEN l_partkey % 4 = 0 THEN CAST(ts + INTERVAL '2' HOUR AS TIMESTAMP) END AS identity_resolution_hook_ts,
  CASE WHEN ccy = 'EUR' AND rail = 'WIRE' THEN 'DE' WHEN ccy = 'GBP' AND rail = 'WIRE' THEN 'GB' END AS iban_country_code,
  CASE WHEN state = 'RETURNED' AND l_linenumber > 1 THEN l_orderkey || '-' || (l_linenumber - 1)
    WHEN rail IN ('RTP', 'FEDNOW') AND l_linenumber % 2 = 0 THEN l_orderkey || '-' || (l_linenumber - 1)
    WHEN rail = 'BILLPAY' THEN l_orderkey || '-' || (1 + l_partkey % 4) END AS original_reference,
  'v2' AS rail_schema_version,
  CASE rail
    WHEN 'ACH' THEN '{"rail_schema_version":"v2","rail_type":"ACH","entry_class_code":"'
      || CASE l_suppkey % 5 WHEN 0 THEN 'PPD' WHEN 1 THEN 'CCD' WHEN 2 THEN 'WEB' WHEN 3 THEN 'TEL' ELSE 'ZZZ' END
      || '","transaction_type":"' || CASE WHEN l_linestatus = 'O' THEN 'DEBIT' ELSE 'CREDIT' END || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"trace_number":"' || CASE WHEN l_partkey % 70 = 0 THEN 'BAD' ELSE lpad(CAST(l_orderkey AS STRING), 15, '0') END || '"' END
      || ',"company_entry_description":"' || CASE WHEN l_suppkey % 3 = 0 THEN 'PAYROLL' WHEN l_suppkey % 3 = 1 THEN 'AUTOPAY' ELSE 'VENDOR PAYMENT TOO LONG' END || '"'
      || ',"same_day_flag":' || CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END
      || CASE WHEN l_linenumber % 2 = 0 THEN ',"addenda_records":[{"sequence_number":1,"addenda_type_code":"05","payment_related_information":"INV ' || l_partkey || '"},{"sequence_number":2,"addenda_type_code":"99","payment_related_information":null}]' ELSE '' END
      || CASE WHEN state = 'RETURNED' THEN ',"return_details":{"return_reason_code":"R0' || (1 + l_partkey % 9) || '","return_date":"2001-01-01","original_trace_number":"' || lpad(CAST(l_orderkey AS STRING), 15, '0') || '"}' ELSE '' END
      || CASE WHEN l_partkey % 90 = 0 THEN ',"surprise":1' ELSE '' END || '}'
    WHEN 'WIRE' THEN '{"rail_schema_version":"v2","rail_type":"WIRE","wire_subtype":"' || CASE WHEN ccy = 'USD' THEN 'FEDWIRE_DOMESTIC' ELSE 'SWIFT_INTERNATIONAL' END || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"imad":"' || lpad(CAST(l_orderkey AS STRING), 22, '0') || '"' END
      || ',"charges_borne_by":"' || CASE l_suppkey % 3 WHEN 0 THEN 'SENDER' WHEN 1 THEN 'RECEIVER' ELSE 'SHARED' END || '"'
      || ',"originator_to_beneficiary_information":"invoice ' || l_partkey || '"'
      || CASE WHEN ccy <> 'USD' THEN ',"foreign_exchange":{"exchange_rate":1.25,"original_currency_code":"' || ccy || '","original_amount":' || CAST(amt AS STRING) || '}' ELSE '' END
      || CASE WHEN l_linenumber % 3 = 0 THEN ',"regulatory_reporting":[{"authority":"FRB","reporting_code":"C' || (l_suppkey % 4) || '","information":null},{"authority":"ECB","reporting_code":"S1","information":"x"}]' ELSE '' END || '}'
    WHEN 'CARD' THEN '{"rail_schema_version":"v2","rail_type":"CARD"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"card_type":"' || CASE l_suppkey % 3 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'CREDIT' ELSE 'PREPAID' END || '"' END
      || ',"card_brand":"VISA","transaction_subtype":"' || CASE l_suppkey % 4 WHEN 0 THEN 'AUTH_CAPTURE' WHEN 1 THEN 'CHARGEBACK' WHEN 2 THEN 'REFUND' ELSE 'CAPTURE' END || '"'
      || ',"merchant_category_code":"' || CASE WHEN l_partkey % 60 = 2 THEN '54X1' ELSE CAST(5400 + l_partkey % 12 AS STRING) END || '"'
      || ',"issuer_response_code":"' || CASE WHEN l_suppkey % 5 = 0 THEN '05' ELSE '00' END || '","card_present":' || CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END
      || CASE WHEN l_suppkey % 4 = 1 THEN ',"chargeback_details":{"chargeback_reason_code":"10.' || (l_partkey % 4) || '","chargeback_date":"2001-01-01","chargeback_amount":' || CAST(amt AS STRING) || ',"dispute_status":"' || CASE l_suppkey % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'WON' ELSE 'LOST' END || '"}' ELSE '' END || '}'
    WHEN 'ZELLE' THEN '{"rail_schema_version":"v2","rail_type":"ZELLE"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"zelle_reference_id":"Z' || l_orderkey || '"' END
      || ',"transaction_subtype":"SEND_MONEY","memo":"rent ' || (l_partkey % 9) || '","enrollment_status":"' || CASE WHEN l_suppkey % 2 = 0 THEN 'ENROLLED' ELSE 'MAYBE' END || '"}'
    WHEN 'RTP' THEN '{"rail_schema_version":"v2","rail_type":"RTP","transaction_subtype":"' || CASE WHEN l_linenumber % 2 = 0 THEN 'REQUEST_FOR_PAYMENT_RESPONSE' ELSE 'REQUEST_FOR_PAYMENT' END || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"rtp_transaction_id":"R' || row_hash || '"' END
      || CASE WHEN state = 'RETURNED' THEN ',"return_details":{"return_reason_code":"AC0' || (l_partkey % 5) || '","return_ts":"2001-01-01T00:00:00Z"}' ELSE '' END
      || ',"request_for_payment":{"rfp_id":"P' || l_orderkey || '","rfp_status":"OPEN","rfp_expiry_date":"2001-06-01T00:00:00Z"}}'
    WHEN 'FEDNOW' THEN '{"rail_schema_version":"v2","rail_type":"FEDNOW","transaction_subtype":"' || CASE WHEN l_linenumber % 2 = 0 THEN 'CREDIT_TRANSFER' ELSE 'REQUEST_FOR_PAYMENT' END || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"fednow_transaction_id":"F' || row_hash || '"' END || ',"purpose_code":"' || CASE WHEN l_suppkey % 9 = 0 THEN 'TOOLONG' ELSE 'GDDS' END || '"}'
    WHEN 'BILLPAY' THEN '{"rail_schema_version":"v2","rail_type":"BILLPAY","bill_pay_reference":"B' || l_orderkey || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"biller_id":"' || l_suppkey || '"' END
      || ',"delivery_method":"' || CASE o_custkey % 4 WHEN 0 THEN 'ELECTRONIC_ACH' WHEN 1 THEN 'ELECTRONIC_REAL_TIME' WHEN 2 THEN 'PAPER_CHECK' ELSE 'LASER_DRAFT' END || '"'
      || ',"biller_category":"UTILITY","memo":"bill ' || (l_partkey % 30) || '","recurring_details":{"is_recurring":' || CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'true' ELSE 'false' END || ',"frequency":"MONTHLY"}}'
    ELSE '{"rail_schema_version":"v2","rail_type":"' || rail || '"'
      || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ',"check_subtype":"' || CASE WHEN rail = 'RDC' THEN 'RDC_MOBILE' ELSE 'PAPER_CHECK' END || '"' END
      || ',"check_number":"' || l_orderkey || '","memo_line":"check ' || (l_partkey % 11) || '"'
      || CASE WHEN state = 'RETURNED' THEN ',"return_details":{"return_reason_code":"NSF","return_date":"2001-01-01"}' ELSE '' END
      || ',"rdc_details":{"image_quality_score":' || (l_partkey % 120) || ',"iqv_result":"PASS"}}'
  END AS rail_details_json,
  '{"aml_status":"' || CASE l_suppkey % 3 WHEN 0 THEN 'CLEAR' WHEN 1 THEN 'REVIEW' ELSE 'PENDING' END || '","sanction_status":"'
    || CASE WHEN l_partkey % 40 = 0 THEN 'HIT' ELSE 'CLEAR' END || '","fraud_score":' || (l_partkey % 100) || ',"flags":['
    || CASE WHEN l_suppkey % 3 = 1 THEN '"STRUCTURING","VELOCITY"' WHEN l_suppkey % 3 = 2 THEN '"VELOCITY"' ELSE '' END || ']}' AS compliance_json,
  CASE WHEN rail IN ('CARD', 'BILLPAY') THEN '[{"type":"NETWORK","amount":' || (l_partkey % 7) || '.25},{"type":"INTERCHANGE","amount":' || (l_suppkey % 5) || '.50}]' END AS fee_breakdown_json,
  'v4' AS schema_version, ts AS event_ts, ts + (l_suppkey % 7) * INTERVAL '1' HOUR AS ingestion_ts,
  lpad(CAST(l_partkey AS STRING), 10, '0') AS _cdc_sequence_id, op AS _cdc_operation,
  CAST(l_shipdate AS TIMESTAMP) AS _cdc_timestamp, source AS _cdc_source_system,
  CAST(l_shipdate + (l_partkey % 90) * INTERVAL '1' MINUTE AS TIMESTAMP) AS _cdc_load_timestamp
FROM base
"""

CDC = """
  lpad(CAST(l_partkey AS STRING), 10, '0') AS _cdc_sequence_id, op AS _cdc_operation,
  CAST(l_shipdate AS TIMESTAMP) AS _cdc_timestamp, source AS _cdc_source_system,
  CAST(l_shipdate + (l_partkey % 90) * INTERVAL '1' MINUTE AS TIMESTAMP) AS _cdc_load_timestamp"""
CHANNEL = "CASE l_suppkey % 6 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'BRANCH' WHEN 3 THEN 'API' WHEN 4 THEN 'FILE' END"

TABLES["raw_ach"] = f"""
SELECT row_hash AS ach_transaction_id, tenant AS tenant_id, lpad(CAST(l_orderkey AS STRING), 15, '0') AS trace_number,
  CAST(l_suppkey AS STRING) AS batch_number, 'F' || (l_suppkey % 10) AS file_id,
  CASE WHEN l_linestatus = 'O' THEN '27' ELSE '22' END AS transaction_code,
  CASE l_suppkey % 4 WHEN 0 THEN 'PPD' WHEN 1 THEN 'CCD' WHEN 2 THEN 'WEB' ELSE 'TEL' END AS entry_class_code,
  CASE WHEN l_linestatus = 'O' THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
  CASE WHEN l_linestatus = 'O' THEN -amt ELSE amt END AS amount,
  CAST(ts AS DATE) AS effective_entry_date,
  CASE WHEN state = 'SETTLED' THEN CAST(ts + INTERVAL '1' DAY AS DATE) END AS settlement_date,
  l_partkey % 2 = 0 AS same_day_flag, CASE WHEN l_linestatus = 'O' THEN 'OUTBOUND' ELSE 'INBOUND' END AS direction,
  orig_routing AS originator_routing_number, md5('acct:' || orig_party) AS originator_account_number,
  bene_routing AS receiver_routing_number, md5('acct:' || bene_party) AS receiver_account_number,
  CASE WHEN l_suppkey % 3 = 0 THEN 'PAYROLL' WHEN l_suppkey % 3 = 1 THEN 'AUTOPAY' ELSE 'VENDOR' END AS company_entry_description,
  l_linenumber % 2 = 0 AS addenda_record_indicator,
  CASE WHEN state = 'RETURNED' THEN 'R0' || (1 + l_partkey % 9) END AS return_reason_code,
  CASE WHEN state = 'RETURNED' THEN CAST(ts + INTERVAL '2' DAY AS DATE) END AS return_date,
  CASE state WHEN 'SETTLED' THEN '00' WHEN 'PENDING' THEN '01' WHEN 'RETURNED' THEN 'R0' || (1 + l_partkey % 9) ELSE state END AS status,
  'ACH_SVC' AS source_product, {CHANNEL} AS channel, ts AS created_timestamp, {CDC}
FROM base WHERE rail = 'ACH'
"""
TABLES["raw_wire"] = f"""
SELECT row_hash AS wire_transaction_id, tenant AS tenant_id, lpad(CAST(l_orderkey AS STRING), 22, '0') AS imad, 'O' || l_orderkey AS omad,
  CASE WHEN ccy = 'USD' THEN 'DOMESTIC' ELSE 'INTERNATIONAL' END AS wire_type,
  CASE WHEN l_linestatus = 'O' THEN 'OUTBOUND' ELSE 'INBOUND' END AS direction, amt AS amount, ccy AS currency_code,
  CASE WHEN ccy <> 'USD' AND l_partkey % 4 <> 0 THEN CAST(CASE WHEN ccy = 'EUR' THEN 1.25 ELSE 1.50 END + (l_orderkey % 100) * 0.0001 AS DECIMAL(18,8)) END AS fx_rate,
  CASE WHEN ccy <> 'USD' THEN CAST(amt * (CASE WHEN ccy = 'EUR' THEN 1.25 ELSE 1.50 END + (l_orderkey % 100) * 0.0001) AS DECIMAL(18,2)) END AS usd_equivalent_amount,
  orig_routing AS sender_routing_number, md5('acct:' || orig_party) AS sender_account_number,
  bene_routing AS beneficiary_routing_number, md5('acct:' || bene_party) AS beneficiary_account_number,
  CASE WHEN ccy = 'EUR' THEN 'DE' WHEN ccy = 'GBP' THEN 'GB' END AS beneficiary_country,
  'GDDS' AS purpose_code, 'invoice ' || l_partkey AS reference_for_beneficiary, 'CTR' AS fedwire_business_function,
  CASE WHEN l_partkey % 40 = 1 THEN 'HOLD' ELSE 'PASS' END AS ofac_screening_status,
  state AS status, 'WIRE_SVC' AS source_product, {CHANNEL} AS channel, ts AS initiated_timestamp,
  ts + INTERVAL '1' HOUR AS sent_timestamp, CASE WHEN state = 'SETTLED' THEN ts + INTERVAL '30' HOUR END AS completed_timestamp, {CDC}
FROM base WHERE rail = 'WIRE'
"""
TABLES["raw_card"] = f"""
SELECT row_hash AS card_transaction_id, tenant AS tenant_id, CAST(l_partkey % 1000000 AS STRING) AS authorization_code,
  CASE l_suppkey % 3 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'CREDIT' ELSE 'PREPAID' END AS card_type,
  CASE l_suppkey % 4 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' WHEN 2 THEN 'AMEX' ELSE 'DISCOVER' END AS card_brand,
  md5('acct:' || orig_party) AS card_number_token, lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') AS card_last_four,
  CASE l_partkey % 5 WHEN 0 THEN 'REFUND' WHEN 1 THEN 'REVERSAL' ELSE 'PURCHASE' END AS transaction_type,
  CASE l_suppkey % 3 WHEN 0 THEN 'RECURRING' WHEN 1 THEN 'CHIP' ELSE 'KEYED' END AS entry_mode,
  amt AS amount, ccy AS currency_code,
  CASE WHEN ccy <> 'USD' THEN CAST(amt * CASE WHEN ccy = 'EUR' THEN 1.25 ELSE 1.50 END AS DECIMAL(18,2)) ELSE amt END AS billing_amount,
  'USD' AS billing_currency, CAST(l_partkey % 3 AS DECIMAL(18,2)) AS surcharge_amount,
  'M' || l_suppkey AS merchant_id, CAST(5400 + l_partkey % 12 AS STRING) AS merchant_category_code,
  CASE WHEN l_suppkey % 5 = 0 THEN '05' ELSE '00' END AS network_response_code,
  l_suppkey % 3 = 0 AS is_recurring, l_partkey % 2 = 0 AS is_card_present,
  CASE WHEN l_suppkey % 4 = 1 THEN 'OPEN' END AS dispute_status, CASE WHEN l_suppkey % 4 = 1 THEN '10.' || (l_partkey % 4) END AS dispute_reason_code,
  CAST(amt * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS interchange_fee, CAST(0.1 AS DECIMAL(18,4)) AS network_fee,
  state AS status, 'CARD_SVC' AS source_product, {CHANNEL} AS channel,
  CASE WHEN l_partkey % 10 <> 2 THEN ts END AS auth_timestamp, CASE WHEN state = 'SETTLED' THEN ts + INTERVAL '26' HOUR END AS settlement_timestamp,
  ts + INTERVAL '40' HOUR AS posted_timestamp, {CDC}
FROM base WHERE rail = 'CARD'
"""
TABLES["raw_zelle"] = f"""
SELECT row_hash AS zelle_transaction_id, tenant AS tenant_id, 'Z' || l_orderkey AS zelle_network_ref,
  CASE WHEN l_linestatus = 'O' THEN 'SEND' ELSE 'RECEIVE' END AS transaction_type,
  CASE WHEN l_suppkey % 5 = 0 THEN 'P2P_COMMERCIAL' ELSE 'P2P_CONSUMER' END AS payment_type, amt AS amount,
  md5('proxy:' || orig_party) AS sender_token, orig_routing AS sender_fi_id, md5('acct:' || orig_party) AS sender_account_token,
  md5('proxy:' || bene_party) AS receiver_token, bene_routing AS receiver_fi_id, md5('acct:' || bene_party) AS receiver_account_token,
  'rent ' || (l_partkey % 9) AS memo, l_suppkey % 2 = 0 AS is_enrolled_recipient, CAST(l_partkey % 100 AS DECIMAL(18,2)) AS fraud_score,
  state AS status, 'ZELLE_SVC' AS source_product, {CHANNEL} AS channel, ts AS initiated_timestamp,
  CASE WHEN state = 'SETTLED' THEN ts + INTERVAL '1' HOUR END AS completed_timestamp, {CDC}
FROM base WHERE rail = 'ZELLE'
"""
TABLES["raw_rtp_fednow"] = f"""
SELECT row_hash AS instant_payment_id, tenant AS tenant_id, 'N' || l_orderkey AS network_reference_id, rail AS payment_rail,
  'pacs.008' AS message_type,
  CASE WHEN l_linenumber % 2 = 0 THEN 'RFP_RESPONSE' WHEN l_suppkey % 2 = 0 THEN 'REQUEST_FOR_PAYMENT' ELSE 'CREDIT_TRANSFER' END AS transaction_type,
  CASE WHEN l_linestatus = 'O' THEN 'SEND' ELSE 'RECEIVE' END AS direction, amt AS amount,
  orig_routing AS sender_routing_number, md5('acct:' || orig_party) AS sender_account_token,
  bene_routing AS receiver_routing_number, md5('acct:' || bene_party) AS receiver_account_token,
  'E2E' || l_orderkey AS end_to_end_id, 'remit ' || (l_partkey % 30) AS remittance_info,
  CASE WHEN l_linenumber % 2 = 1 AND l_suppkey % 2 = 0 THEN ts + (1 + l_partkey % 72) * INTERVAL '1' HOUR END AS rfp_expiry_timestamp,
  CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey || '-' || (l_linenumber - 1) END AS rfp_original_ref,
  CASE WHEN state = 'RETURNED' THEN 'AC0' || (l_partkey % 5) END AS return_reason_code,
  state AS status, 'INSTANT_SVC' AS source_product, {CHANNEL} AS channel, ts AS initiated_timestamp,
  ts AS acceptance_timestamp, CASE WHEN state = 'SETTLED' THEN ts END AS settled_timestamp, {CDC}
FROM base WHERE rail IN ('RTP', 'FEDNOW')
"""
TABLES["raw_check_rdc"] = f"""
SELECT row_hash AS check_transaction_id, tenant AS tenant_id, CAST(l_orderkey AS STRING) AS check_number,
  CASE l_suppkey % 3 WHEN 0 THEN 'PERSONAL' WHEN 1 THEN 'BUSINESS' ELSE 'CASHIER' END AS check_type,
  CASE WHEN rail = 'RDC' THEN 'MOBILE_RDC' WHEN l_suppkey % 2 = 0 THEN 'BRANCH' ELSE 'ATM' END AS deposit_type,
  CASE WHEN l_linestatus = 'O' THEN 'PRESENTED_CHECK' ELSE 'DEPOSIT' END AS transaction_type, amt AS amount,
  orig_routing AS payer_routing_number, md5('acct:' || orig_party) AS payer_account_number,
  md5('acct:' || bene_party) AS payee_account_token,
  CASE CAST(l_quantity AS BIGINT) % 5 WHEN 0 THEN 'NONE' WHEN 1 THEN 'REG_CC' WHEN 2 THEN 'LARGE_DEPOSIT' WHEN 3 THEN 'EXCEPTION' ELSE 'NEW_ACCOUNT' END AS hold_type,
  CAST(CASE WHEN CAST(l_quantity AS BIGINT) % 5 = 0 THEN 0 ELSE l_quantity * 10 END AS DECIMAL(18,2)) AS hold_amount,
  CAST(ts + (1 + CAST(l_quantity AS BIGINT) % 7) * INTERVAL '1' DAY AS DATE) AS funds_availability_date,
  CAST(l_quantity * 2 AS DECIMAL(18,2)) AS risk_score,
  CASE WHEN state = 'RETURNED' THEN 'NSF' END AS return_reason_code,
  state AS status, 'CHECK_SVC' AS source_product, {CHANNEL} AS channel, ts AS deposit_timestamp,
  CASE WHEN state = 'SETTLED' THEN ts + INTERVAL '48' HOUR END AS cleared_timestamp, {CDC}
FROM base WHERE rail IN ('CHECK', 'RDC')
"""
TABLES["raw_billpay"] = f"""
SELECT row_hash AS bill_pay_transaction_id, tenant AS tenant_id,
  CASE WHEN l_suppkey % 4 = 0 THEN 'BUSINESS' ELSE 'CONSUMER' END AS payment_type,
  CASE l_suppkey % 3 WHEN 0 THEN 'ACH' WHEN 1 THEN 'CARD' ELSE 'CHECK' END AS payment_method, amt AS amount,
  CAST(amt * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS fee_amount,
  CASE WHEN l_suppkey % 3 <> 1 THEN md5('acct:' || orig_party) END AS payer_account_token,
  CASE WHEN l_suppkey % 3 = 1 THEN md5('acct:' || orig_party) END AS payer_card_token,
  CAST(l_suppkey AS STRING) AS biller_id, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_recurring,
  CASE WHEN l_partkey % 2 = 0 THEN 'ANNUAL' ELSE 'MONTHLY' END AS recurrence_frequency,
  CASE o_custkey % 4 WHEN 0 THEN 'ELECTRONIC_ACH' WHEN 1 THEN 'ELECTRONIC_REAL_TIME' WHEN 2 THEN 'PAPER_CHECK' ELSE 'LASER_DRAFT' END AS delivery_method,
  CAST(ts AS DATE) AS scheduled_date, CAST(ts + INTERVAL '3' DAY AS DATE) AS delivery_date, 'CN' || l_orderkey AS confirmation_number,
  state AS status, CASE WHEN state = 'FAILED' THEN 'DECLINED_FUNDING' END AS failure_reason,
  'BILL_SVC' AS source_product, {CHANNEL} AS channel, ts AS created_timestamp, {CDC}
FROM base WHERE rail = 'BILLPAY'
"""

TABLES["dirty"] = """
SELECT CASE WHEN n % 997 = 1 THEN 'twin' ELSE transaction_id END AS transaction_id, tenant_id, source_system, source_transaction_id, event_id,
  CASE WHEN n % 17 = 3 THEN 'CASH' ELSE payment_type END AS payment_type,
  CASE WHEN n % 19 = 4 THEN NULL ELSE payment_rail END AS payment_rail,
  CASE WHEN n % 23 = 5 THEN 'SIDEWAYS' ELSE direction END AS direction,
  CASE WHEN n % 29 = 6 THEN -amount WHEN n % 31 = 2 THEN NULL ELSE amount END AS amount,
  CASE WHEN n % 37 = 7 THEN lower(currency_code) ELSE currency_code END AS currency_code,
  settlement_amount, settlement_currency_code,
  CASE WHEN n % 41 = 8 THEN settlement_currency_code ELSE original_currency_code END AS original_currency_code,
  CASE WHEN n % 43 = 9 THEN NULL ELSE original_amount END AS original_amount, fx_rate, fx_rate_source, transaction_ts,
  CASE WHEN n % 47 = 10 THEN 'DECLINED' ELSE status END AS status,
  CASE WHEN n % 53 = 11 THEN 'R99' ELSE return_reason_code END AS return_reason_code,
  CASE WHEN n % 5 = 0 THEN description END AS description, is_recurring, is_on_us,
  CASE WHEN n % 59 = 12 THEN 'GHOST' ELSE originator_party_id END AS originator_party_id, beneficiary_party_id,
  CASE WHEN n % 61 = 13 THEN 'MAYBE' ELSE originator_resolution_status END AS originator_resolution_status, beneficiary_resolution_status,
  rail_schema_version, CASE WHEN n % 67 = 14 THEN '[1,2]' WHEN n % 71 = 15 THEN 'not json' ELSE rail_details_json END AS rail_details_json,
  schema_version, event_ts, ingestion_ts, _cdc_sequence_id, CASE WHEN n % 73 = 16 THEN 'X' ELSE _cdc_operation END AS _cdc_operation,
  _cdc_timestamp, _cdc_source_system, _cdc_load_timestamp, submitted_ts,
  acknowledged_ts, settled_ts, effective_date, settlement_date
FROM (SELECT *, CAST(_cdc_sequence_id AS BIGINT) AS n FROM txn) x
"""

TABLES["party"] = """
SELECT 'C' || c_custkey AS party_id, CASE WHEN c_custkey % 4 = 0 THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS party_type,
  md5('name:' || c_name) AS name_token, c_name AS display_name,
  md5('tax:' || CASE WHEN c_custkey % 40 = 1 THEN c_custkey - 1 ELSE c_custkey END) AS tax_id_token,
  'US' AS country_code,
  CASE WHEN c_custkey > 0 AND c_custkey % 97 = 0 THEN 'MERGED' ELSE 'CONFIRMED' END AS resolution_status,
  CAST(CASE WHEN c_custkey % 211 = 5 THEN 1.2 ELSE 0.9 END AS DECIMAL(5,4)) AS resolution_confidence,
  CASE WHEN c_custkey > 0 AND c_custkey % 97 = 0 THEN 'C' || CAST(floor(c_custkey / 2) AS BIGINT) END AS merged_into_party_id,
  c_custkey % 97 <> 0 AS is_active, 'T' || (c_custkey % 5) AS tenant_id,
  CAST(TIMESTAMP '1995-01-01 00:00:00' + (c_custkey % 1000) * INTERVAL '1' DAY AS TIMESTAMP) AS created_at
FROM customer
UNION ALL
SELECT 'S' || s_suppkey, 'BILLER', md5('name:' || s_name), s_name, md5('tax:S' || s_suppkey), 'US',
  CASE WHEN s_suppkey % 50 = 7 THEN 'BOGUS' ELSE 'CONFIRMED' END, CAST(1.0 AS DECIMAL(5,4)), CAST(NULL AS STRING), TRUE,
  'T' || (s_suppkey % 5), CAST(TIMESTAMP '1995-01-01 00:00:00' + (s_suppkey % 1000) * INTERVAL '1' DAY AS TIMESTAMP)
FROM supplier
"""
TABLES["party_account"] = """
SELECT 'A' || party_id AS account_id, party_id,
  CASE WHEN party_type = 'BILLER' THEN 'BILLER' WHEN k % 3 = 0 THEN 'SAVINGS' WHEN k % 101 = 1 THEN 'OTHER' ELSE 'CHECKING' END AS account_type,
  k % 3 = 0 AS is_on_us, CAST(100000000 + k % 25 AS STRING) AS institution_routing_number,
  'FI ' || (k % 25) AS institution_name, 'US' AS institution_country_code,
  CASE WHEN k % 4 = 0 THEN 'FIUS33' || (10 + k % 25) END AS institution_swift_bic,
  CASE WHEN k % 10 = 0 THEN 'DE' END AS institution_iban_country_code,
  md5('acct:' || party_id) AS account_number_token,
  CASE WHEN k % 103 = 2 THEN 'RAW' ELSE 'INTERNAL' END AS account_token_type,
  lpad(CAST(k % 10000 AS STRING), 4, '0') AS card_last_four, md5('proxy:' || party_id) AS proxy_value_token,
  'ACTIVE' AS account_status, tenant_id, created_at
FROM (SELECT *, CAST(substring(party_id, 2) AS BIGINT) AS k FROM party) p
"""
TABLES["party_relationship"] = """
SELECT * FROM (
  SELECT 'J' || c_custkey AS relationship_id, 'C' || c_custkey AS party_id_a, 'C' || (c_custkey + 1) AS party_id_b, 'JOINT_ACCOUNT' AS relationship_type,
    'OWNER' AS role_a, 'JOINT_HOLDER' AS role_b, CAST(NULL AS DECIMAL(5,2)) AS ownership_percentage, DATE '1995-01-01' AS effective_date,
    CAST(NULL AS DATE) AS expiry_date, TRUE AS is_active, 'T' || (c_custkey % 5) AS tenant_id
  FROM customer WHERE c_custkey % 10 = 0
  UNION ALL
  SELECT 'U' || c_custkey, 'C' || c_custkey, 'C' || CAST(floor(c_custkey / 3) AS BIGINT), 'BENEFICIAL_OWNER', 'BUSINESS', 'INDIVIDUAL',
    CAST(100 - c_custkey % 50 AS DECIMAL(5,2)), DATE '1996-01-01', CASE WHEN c_custkey % 9 = 0 THEN DATE '2000-06-30' END, c_custkey % 31 <> 0, 'T' || (c_custkey % 5)
  FROM customer WHERE c_custkey > 0 AND c_custkey < 300
  UNION ALL
  SELECT 'H' || c_custkey, 'C' || CAST(floor(c_custkey / 2) AS BIGINT), 'C' || c_custkey, 'PARENT_SUBSIDIARY', 'PARENT', 'SUBSIDIARY',
    CAST(60.00 AS DECIMAL(5,2)), DATE '1997-01-01', CAST(NULL AS DATE), TRUE, 'T' || (c_custkey % 5)
  FROM customer WHERE c_custkey >= 30 AND c_custkey < 400
  UNION ALL
  SELECT 'G' || c_custkey, 'C' || (c_custkey - c_custkey % 20), 'C' || c_custkey, 'AUTHORIZED_SIGNER', 'BUSINESS', 'TREASURER',
    CAST(NULL AS DECIMAL(5,2)), DATE '1995-06-01', CAST(NULL AS DATE), c_custkey % 6 <> 1, 'T' || (c_custkey % 5)
  FROM customer WHERE c_custkey % 4 = 1
) r
WHERE party_id_a IN (SELECT 'C' || c_custkey FROM customer) AND party_id_b IN (SELECT 'C' || c_custkey FROM customer)
"""
TABLES["on_us_institutions"] = """
SELECT 'T' || (n_nationkey % 5) AS tenant_id, CAST(100000000 + n_nationkey AS STRING) AS routing_number, n_name AS institution_name,
  n_nationkey % 2 = 0 AS is_rtp_participant, n_nationkey % 3 = 0 AS is_fednow_participant, n_nationkey % 4 <> 0 AS is_zelle_participant,
  n_nationkey <> 13 AS is_active, DATE '1990-01-01' AS effective_date,
  CASE WHEN n_nationkey % 7 = 0 THEN DATE '1998-12-31' END AS expiry_date
FROM nation
"""
TABLES["biller_registry"] = """
SELECT 'R' || s_suppkey AS biller_registry_id, 'S' || s_suppkey AS party_id, CAST(s_suppkey AS STRING) AS biller_id,
  'B' || (s_suppkey % 40) AS standard_biller_id,
  CASE s_suppkey % 10 WHEN 0 THEN 'UTILITIES' WHEN 1 THEN 'TELECOM' WHEN 2 THEN 'INSURANCE' WHEN 3 THEN 'MORTGAGE' WHEN 4 THEN 'AUTO_LOAN'
    WHEN 5 THEN 'CREDIT_CARD' WHEN 6 THEN 'GOVERNMENT' WHEN 7 THEN 'HEALTHCARE' WHEN 8 THEN 'SUBSCRIPTION' ELSE 'OTHER' END AS biller_category,
  CASE s_suppkey % 5 WHEN 0 THEN 'AGG_A' WHEN 1 THEN 'AGG_B' WHEN 2 THEN 'AGG_C' WHEN 3 THEN 'AGG_D' ELSE 'OTHER' END AS aggregator_name,
  split(CASE s_suppkey % 3 WHEN 0 THEN 'ACH,CHECK' WHEN 1 THEN 'ACH,RTP,CARD' ELSE 'CHECK' END, ',') AS payment_methods,
  TRUE AS is_active, 'T' || (s_suppkey % 5) AS tenant_id
FROM supplier
"""
TABLES["party_address"] = """
SELECT 'L' || party_id AS address_id, party_id,
  CASE WHEN k % 8 = 0 THEN 'CORRESPONDENT' WHEN k % 107 = 3 THEN 'SECRET' ELSE 'MAILING' END AS address_type,
  md5('addr:' || CASE WHEN k % 40 = 2 THEN k - 2 ELSE k END) AS address_line1_token,
  'US' AS country_code, CASE WHEN k % 8 = 0 THEN 'CORRUS' || (10 + k % 25) END AS correspondent_bank_bic,
  CASE WHEN k % 8 = 0 THEN 'Correspondent ' || (k % 25) END AS correspondent_bank_name, TRUE AS is_primary, tenant_id
FROM (SELECT *, CAST(substring(party_id, 2) AS BIGINT) AS k FROM party) p
"""
TABLES["party_account_rail_ref"] = """
SELECT 'F' || o_orderkey AS rail_ref_id, 'AC' || o_custkey AS account_id,
  CASE o_orderkey % 10 WHEN 0 THEN 'ACH' WHEN 1 THEN 'WIRE' WHEN 2 THEN 'CARD' WHEN 3 THEN 'ZELLE' WHEN 4 THEN 'RTP'
    WHEN 5 THEN 'FEDNOW' WHEN 6 THEN 'CHECK' WHEN 7 THEN 'RDC' WHEN 8 THEN 'BILLPAY' ELSE 'PIGEON' END AS rail_type,
  o_orderkey % 2 = 0 AS is_receiving_participant, o_orderkey % 3 = 0 AS is_originating_participant,
  CASE WHEN o_orderkey % 17 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS participant_status, 'T' || (o_custkey % 5) AS tenant_id
FROM orders
"""
TABLES["party_event"] = """
SELECT 'V' || o_orderkey AS resolution_event_id, 'C' || o_custkey AS source_party_id,
  CASE WHEN o_orderkey % 30 IN (0, 1) THEN 'C' || CAST(floor(o_custkey / 2) AS BIGINT) END AS target_party_id,
  CASE o_orderkey % 30 WHEN 0 THEN 'MERGE' WHEN 1 THEN 'SUPERSEDED' WHEN 2 THEN 'SPLIT' WHEN 3 THEN 'NOISE' ELSE 'MATCH_CONFIRMED' END AS event_type,
  CASE WHEN o_orderkey % 50 = 0 THEN 'GUESS' ELSE 'MANUAL' END AS resolution_method,
  CAST(o_orderdate AS TIMESTAMP) AS resolved_at, 'T' || (o_custkey % 5) AS tenant_id
FROM orders
"""
TABLES["ir_queue"] = """
SELECT 'Q' || o_orderkey AS transaction_id, 'T' || (o_custkey % 5) AS tenant_id,
  CASE WHEN o_orderkey % 10 < 6 THEN md5('acct:C' || o_custkey) ELSE 'unknown-' || o_orderkey END AS originator_account_token,
  CASE WHEN o_orderkey % 10 IN (6, 8) THEN CAST(100000000 + o_custkey % 25 AS STRING) END AS originator_routing_number,
  CASE WHEN o_orderkey % 10 = 6 THEN lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') END AS originator_last4,
  CASE WHEN o_orderkey % 10 = 7 THEN md5('proxy:C' || o_custkey) END AS originator_proxy_token,
  CASE WHEN o_orderkey % 10 = 8 THEN md5('name:' || c_name) END AS originator_name_token,
  CASE WHEN o_orderkey % 4 = 0 THEN md5('acct:C' || o_custkey) ELSE 'unknown-b' || (o_orderkey % 500) END AS beneficiary_account_token,
  CAST(NULL AS STRING) AS beneficiary_routing_number, CAST(NULL AS STRING) AS beneficiary_last4,
  CAST(NULL AS STRING) AS beneficiary_proxy_token, CAST(NULL AS STRING) AS beneficiary_name_token,
  'UNRESOLVED' AS originator_resolution_status, CASE WHEN o_orderkey % 3 = 0 THEN 'CONFIRMED' ELSE 'UNRESOLVED' END AS beneficiary_resolution_status,
  CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderdate + INTERVAL '1' DAY AS TIMESTAMP) END AS identity_resolution_hook_ts,
  CAST(o_orderdate AS TIMESTAMP) AS transaction_ts
FROM orders JOIN customer ON o_custkey = c_custkey
"""
TABLES["rail_v1"] = """
SELECT row_hash AS transaction_id, rail AS payment_type, 'v1' AS rail_schema_version,
  CASE rail WHEN 'ACH' THEN '{"rail_schema_version":"v1","rail_type":"ACH","fields":{"trace_number":"' || CASE WHEN l_partkey % 50 = 0 THEN 'BAD' ELSE lpad(CAST(l_orderkey AS STRING), 15, '0') END
      || '","entry_class_code":"PPD","transaction_type":"' || CASE l_suppkey % 4 WHEN 0 THEN 'CR' WHEN 1 THEN 'DR' WHEN 2 THEN 'Credit' ELSE 'Debit' END
      || '","transaction_code":"27","batch_number":"B' || (l_suppkey % 7) || '","file_id":"F1","addenda_record_indicator":false,"noc_code":"C01","return_reason_code":"R0' || (l_partkey % 9) || '","return_date":"2001-01-02","addenda_information":"note ' || (l_suppkey % 5) || '","same_day_flag":true}}'
    WHEN 'CARD' THEN '{"rail_schema_version":"v1","rail_type":"CARD","fields":{"card_type":"DEBIT","card_brand":"VISA","transaction_type":"' || CASE l_suppkey % 3 WHEN 0 THEN 'SETTLEMENT' WHEN 1 THEN 'REFUND' ELSE 'CAPTURE' END
      || '","merchant_category_code":"' || (5400 + l_partkey % 12) || '","card_entry_mode":"' || CASE l_suppkey % 3 WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'ECOM' ELSE 'CHIP' END
      || '","merchant_id":"M' || l_suppkey || '","authorization_code":"A1","terminal_id":"T' || (l_suppkey % 9) || '","network_reference_id":"N' || l_orderkey || '","card_present":true,"cvv_present":false}}'
    ELSE '{"rail_schema_version":"v1","rail_type":"WIRE","fields":{"wire_reference_number":"W' || l_orderkey || '","wire_type":"' || CASE WHEN ccy = 'USD' THEN 'DOMESTIC' ELSE 'INTERNATIONAL' END
      || '","charges":"' || CASE l_suppkey % 3 WHEN 0 THEN 'OUR' WHEN 1 THEN 'SHA' ELSE 'BEN' END
      || '","beneficiary_bank_name":"Bank ' || (l_suppkey % 6) || '","sender_reference":"S' || l_orderkey || '","beneficiary_country":"DE","payment_instruction":"pay ' || (l_partkey % 8) || '"' || CASE WHEN l_partkey % 60 = 1 THEN ',"odd":"x"' ELSE '' END || '}}' END AS rail_details_json
FROM base WHERE rail IN ('ACH', 'CARD', 'WIRE')
"""
TABLES["source_feed"] = """
SELECT row_hash AS txn_id, tenant AS tenant_fi_id, CASE WHEN l_linestatus = 'O' THEN -amt ELSE amt END AS txn_amt,
  CASE WHEN l_partkey % 40 = 0 THEN 'bad' ELSE substring(CAST(l_shipdate AS STRING), 3, 2) || substring(CAST(l_shipdate AS STRING), 6, 2) || substring(CAST(l_shipdate AS STRING), 9, 2) END AS eff_dt,
  CASE state WHEN 'SETTLED' THEN '00' WHEN 'PENDING' THEN '01' WHEN 'RETURNED' THEN 'R0' || (1 + l_partkey % 9) ELSE '99' END AS txn_status,
  lpad(CAST(l_orderkey AS STRING), 15, '0') AS trace_num, CASE WHEN l_linestatus = 'O' THEN 'DR' ELSE 'CR' END AS txn_type,
  CASE WHEN l_partkey % 2 = 0 THEN 'Y' WHEN l_partkey % 7 = 0 THEN NULL ELSE 'N' END AS same_day_flg,
  'ACCT' || lpad(CAST(o_custkey AS STRING), 12, '0') AS orig_acct_num, orig_routing AS odfi_routing, bene_routing AS rdfi_routing,
  CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_partkey % 2 = 0 THEN 'DEBIT' ELSE 'SEND' END ELSE CASE WHEN l_partkey % 2 = 0 THEN 'CREDIT' ELSE 'RECEIVE' END END AS flow,
  rail AS payment_type
FROM base
"""
TABLES["activity"] = """
SELECT CAST(event_id AS STRING) AS transaction_id, 'T' || (user_id % 5) AS tenant_id, 'U' || user_id AS originator_party_id,
  'K' || k AS beneficiary_party_id,
  CASE event_type WHEN 'signup' THEN 'ACH' WHEN 'error' THEN 'WIRE' WHEN 'click' THEN 'CARD' WHEN 'view' THEN 'ZELLE' ELSE 'BILLPAY' END AS payment_type,
  CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SETTLED' END AS status,
  CAST(value AS DECIMAL(18,2)) AS amount,
  CASE WHEN k % 4 = 0 THEN 'EUR' WHEN k % 4 = 1 THEN 'GBP' END AS original_currency_code,
  CASE WHEN k % 4 < 2 THEN 'USD' END AS settlement_currency_code,
  CASE WHEN k % 4 < 2 THEN CAST(1.25 + (event_id % 100) * 0.0001 AS DECIMAL(18,8)) END AS fx_rate,
  CASE WHEN k % 5 = 0 THEN 'DE' WHEN k % 5 = 1 THEN 'US' END AS iban_country_code,
  CASE event_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_on_us,
  CAST(100000000 + event_id % 3 AS STRING) AS originator_routing_number,
  CASE event_id % 10 WHEN 6 THEN 'ROUTING_ACCOUNT' WHEN 7 THEN 'PROXY_EXACT' WHEN 8 THEN 'NAME_ROUTING' WHEN 9 THEN 'NEW_PARTY' ELSE 'EXACT_TOKEN' END AS originator_match_rule,
  event_id % 2 = 0 AS is_recurring, CASE WHEN event_id % 2 = 0 THEN 'INBOUND' ELSE 'OUTBOUND' END AS direction,
  CAST(ts AS TIMESTAMP) AS transaction_ts
FROM (SELECT e.*, CAST(@json(e.props, k) AS BIGINT) AS k FROM events e) x
"""
TABLES["activity_party"] = """
SELECT DISTINCT 'U' || user_id AS party_id, 'INDIVIDUAL' AS party_type, 'T' || (user_id % 5) AS tenant_id,
  CAST(TIMESTAMP '2023-01-01 00:00:00' + (user_id % 400) * INTERVAL '1' DAY AS TIMESTAMP) AS created_at
FROM events
"""

_JSON = re.compile(r"@json\(([\w.]+), (\w+)\)")


def _body(name: str, spark: bool) -> str:
    form = r"get_json_object(\1, '$.\2')" if spark else r"json_extract_string(\1, '$.\2')"
    return _JSON.sub(form, TABLES[name])


def _closure(names: list[str]) -> list[str]:
    """Derived tables needed for ``names``, inputs first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in TABLES:
            if other != name and re.search(rf"\b(?:FROM|JOIN) {other}\b", TABLES[name]):
                visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table as a DataFrame; Catalyst prunes what is not used."""
    if name in GIVEN:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    derived = _closure([name])
    text = " ".join(TABLES[d] for d in derived)
    given = [g for g in GIVEN if re.search(rf"\b(?:FROM|JOIN) {g}\b", text)]
    ctes = [f"{g} AS (SELECT * FROM parquet.`{sf_dir}/{g}.parquet`)" for g in given]
    ctes += [f"{d} AS ({_body(d, True)})" for d in derived]
    return spark.sql(f"WITH {', '.join(ctes)} SELECT * FROM {name}")


def oracle(names: str, body: str) -> str:
    """``body`` prefixed with the derived tables it reads, for the checking engine."""
    ctes = [f"{d} AS ({_body(d, False)})" for d in _closure(names.split())]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"


def stream(spark: SparkSession, sf_dir: str, name: str, source: str) -> DataFrame:
    """A derived table as a stream: the given table ``source`` arrives as files, the rest is static."""
    schema = spark.read.parquet(f"{sf_dir}/{source}.parquet").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", f"{source}.parquet").parquet(sf_dir)
    view = f"railweave_stream_{source}"
    arriving.createOrReplaceTempView(view)
    derived = _closure([name])
    text = " ".join(TABLES[d] for d in derived)
    given = [g for g in GIVEN if re.search(rf"\b(?:FROM|JOIN) {g}\b", text)]
    ctes = [f"{g} AS (SELECT * FROM {view})" if g == source else f"{g} AS (SELECT * FROM parquet.`{sf_dir}/{g}.parquet`)" for g in given]
    ctes += [f"{d} AS ({_body(d, True)})" for d in derived]
    return spark.sql(f"WITH {', '.join(ctes)} SELECT * FROM {name}")
