"""Explicit schemas of the artefact tables. Loosely typed fields are read as text and cast later."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

INGESTED = (
    "source_file_id string, item_id string, item_type string, "
    "source_location struct<path:string,size_bytes:bigint>, "
    "lineage struct<ingested_by:string,ingested_at:string>, extracted_text_chars bigint, "
    "yield_ratio double, source_kind string, mailbox_owner_email string, message_id string"
)
INPUTS = "path string"
REGISTER = (
    "ref string, filename string, path string, text_file string, hash string, extension string, "
    "status string, notes string, text_quality string, mailbox_owner_email string, source_kind string"
)
PRIMARY = (
    "doc_ref string, durant_verdict string, rationale string, model string, prompt_id string, "
    "prompt_version string, prompt_canonical_seal_sha256 string, prompt_effective_sha256 string, "
    "prompt_applied_strips array<string>, error_state string, elapsed_sec double"
)
RECHECK = (
    "doc_ref string, recheck_verdict string, original_verdict string, original_rationale string, "
    "rationale string, error_state string"
)
SCOPE = (
    "ref string, doc_ref string, scope_verdict string, verdict string, decision_rationale string"
)
CONTEXT = (
    "doc_ref string, durant_verdict string, primary_classification string, is_about_requester string, "
    "confidence string, requester_role string, evidence_snippet string, recommended_action string, "
    "rationale string, error_state string"
)
DEDUPE = "doc_ref string, dedupe_verdict string, dedupe_basis string"
TAGS = (
    "ref string, filename string, entity_count bigint, redact_count bigint, flag_count bigint, "
    "entities array<struct<text:string,type:string,label:string,source:string,classification:string,"
    "redact:string,start:string,end:string>>"
)
EMBEDDINGS = "ref string, embedding array<float>, upstream_hash string"
PREFILTER = (
    "ref string, cosine_score double, passes boolean, verdict string, threshold double, "
    "upstream_hash string, schema_version string, producer_version string"
)
RERANK = "ref string, rerank_score double, would_drop boolean, mode string, upstream_hash string"
FINDINGS = "stage int, ref string, surface string, type string, detector string, confidence double"
REDACTION = "doc_ref string, filename string, status string, redaction_count bigint"
PLAN = "ref string, spans array<struct<start:bigint,end:bigint>>, reason_code string"
LEAKS = "ref string, leaks array<string>, checked_at string"
DECISIONS = (
    "ts string, doc_ref string, source_path string, decision string, reason_code string, note string"
)
FLAG_DECISIONS = (
    "ts string, text string, classification string, verdict string, reason_code string, note string, "
    "operator_id string, scope string, doc_refs array<string>, doc_ref string, start bigint, end bigint, "
    "instance_count bigint"
)
CALIBRATION = "ref string, verdict string, notes string, decided_at string, time_taken_s double"
WAIVERS = (
    "waiver_id string, state string, blocker_ids array<string>, operator_id string, justification string, "
    "proposed_ts string, proposed_event_hash string, dpo_id string, dpo_note string, co_signed_ts string, "
    "cosign_event_hash string"
)
AUDIT = (
    "event_id string, event_type string, case_id string, agent string, item_id string, stage string, "
    "prev_hash string, payload string"
)
PIPELINE_LOG = (
    "event string, stage string, ts string, outcome string, reason string, kind string, message string, "
    "error_type string, error_message string, duration_s double, stages_run array<string>, "
    "stages_skipped array<string>, halted boolean, halt_reason string, schema_version string, "
    "producer_version string"
)
PEOPLE = (
    "canonical_name string, emails array<string>, phones array<string>, titles array<string>, "
    "source_refs array<string>, correlation_ids array<string>, mention_count string, "
    "distinct_doc_count string, is_data_subject boolean, is_subject_confidence string, "
    "subject_centricity_score string, confidence_score string, text_quality_summary string, "
    "discovered_by string"
)
SUBJECT = (
    "full_name string, aliases array<string>, email string, additional_emails array<string>, "
    "subject_protected_phrases array<string>, subject_phones array<string>, "
    "request_received_date string, vulnerable boolean"
)
