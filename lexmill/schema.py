"""Row types of the data model, declared so that map-like objects are never inferred as structs."""

from __future__ import annotations

UNIT = "unit_id bigint, plugin string, rec string, edid string, source string, dest string"

TERM = "struct<decision_status:string,enforcement:string,target:string,forbidden:array<string>,match:struct<kind:string,accepted:array<string>,blocked_suffixes:array<string>>,origin:string,source:string,evidence:string,note:string>"
BINDING = "struct<term_id:string,source_span:string,required:boolean,required_target:string>"
BAN = "struct<english:string,forbidden:array<string>,target:string,reason:string,category:string,unconditional:boolean>"
EXEMPTION = "struct<english:string,forbidden:string,reason:string,scope:struct<dest_left:array<string>,dest_right:array<string>,source_contains:array<string>>>"
CONTRACT = f"struct<bindings:array<{BINDING}>,terms:map<string,{TERM}>,keep_list:array<string>,keep:array<string>,protected_tokens:array<string>,interjection_map:map<string,array<string>>,global_bans:array<{BAN}>,global_ban_exemptions:array<{EXEMPTION}>,anchored:array<string>>"

CASE = (
    "struct<case_id:string,test_layer:string,category:string,plugin:string,xml_index:bigint,"
    f"input:struct<source:string,translation:string,contract:{CONTRACT},semantic_unit:string,context:string,dictionary:string,contract_evidence:string>,"
    "expect:struct<verdict:string,codes:array<string>,note:string>,"
    "machine_assert:struct<must_contain:array<string>,must_not_contain:array<string>,code:string>,"
    "assertion:struct<must_contain:array<string>,must_not_contain:array<string>,golden_review:boolean>,"
    "golden:string,origin:string,note:string>"
)
CASE_FILE = f"schema_version string, purpose string, collection_date string, provenance string, source_docs array<string>, cases array<{CASE}>"

TRANSLATION = "struct<xml_index:bigint,rec:string,edid:string,source:string,translation:string,status:string,confidence:string,notes:string>"
TRANSLATION_SET = f"translations array<{TRANSLATION}>"
GATE_REPORT = "verdict string, fail_count bigint, warning_count bigint, warnings array<struct<translation_unit_id:string,term_id:string,expected:string>>"
WORKER_REQUEST = "items array<struct<id:string,record_type:string,source:string>>"
WORKER_RESPONSE = "raw_output string, translations array<struct<id:string,record_type:string,source:string,translation:string,protected_tokens:array<string>,keep_literals:array<string>,required_phrases:array<string>>>, validation struct<ok:boolean,errors:array<string>,warnings:array<string>>"

VIOLATION = "struct<code:string,severity:string,term_id:string,form:string,pos:int,expected:string,reason:string>"
