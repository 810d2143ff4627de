"""Schemas of the tables, nested values and files of a rollout data set."""

from __future__ import annotations

from pyspark.sql import types as T

#: A half-open range of task ids, lo <= id < hi.
TASK_RANGE = "struct<lo:int,hi:int>"
TOOL_CALL = "struct<id:string,name:string,arguments:string,malformed:boolean>"
MESSAGE = f"struct<role:string,content:string,reasoning:string,tool_calls:array<{TOOL_CALL}>,tool_call_id:string>"
TRAJECTORY = f"struct<schema_version:int,messages:array<{MESSAGE}>,reward_breakdown:string,agent_trace:string,teacher_meta:string>"
TRACE_EVENT = (
    "type string, data struct<text:string,delta:string,call_id:string,tool:string,args:string,"
    "result_summary:string,exit_code:int,input_tokens:long,output_tokens:long,message:string>"
)

TABLES = {
    "environments": f"env_name string, task_id_range {TASK_RANGE}, config string, created_at timestamp_ntz",
    "tasks": "env_name string, task_id int, problem string, hidden_tests string, difficulty string, meta string, created_at timestamp_ntz",
    "teachers": "teacher_name string, provider string, family string, config string, cost_per_mtok decimal(8,4), active boolean, created_at timestamp_ntz",
    "rollouts": (
        "rollout_id string, env_name string, task_id int, teacher_name string, sample_idx int, seed long, temperature double, top_p double, "
        "reward double, status string, steps int, tokens_in long, tokens_out long, cost_usd decimal(10,6), latency_ms long, trajectory binary, "
        "trajectory_sha256 string, group_label string, created_at timestamp_ntz"
    ),
    "teacher_api_calls": "id long, rollout_id string, teacher_name string, status string, latency_ms long, ts timestamp_ntz",
    "sampling_lists": "list_name string, config string, status string, created_at timestamp_ntz",
    "sampling_progress": (
        "list_name string, env_name string, task_id int, teacher_name string, target_samples int, collected int, attempts int, "
        "last_updated timestamp_ntz, published_at timestamp_ntz, promoted_at timestamp_ntz"
    ),
    "pair_sets": "pair_set_name string, status string, config string, created_at timestamp_ntz",
    "pairs": (
        "pair_id string, pair_set_name string, env_name string, task_id int, teacher_name string, win_rollout_id string, lose_rollout_id string, "
        "reward_gap double, created_at timestamp_ntz"
    ),
    "student_submissions": "student string, revision string, model_hash string, is_valid boolean, submitted_by string, submitted_at timestamp_ntz",
    "anti_copy_results": "student string, revision string, round_ts timestamp_ntz, verdict string, evidence string",
    "student_scores": (
        "run_id string, student string, revision string, pair_set string, mean_score double, win_rate double, status string, is_latest boolean, "
        "triggered_by string, config string, started_at timestamp_ntz, finished_at timestamp_ntz"
    ),
    "student_pair_scores": "run_id string, student string, revision string, pair_id string, ce_win array<double>, ce_lose array<double>, n_win int, n_lose int, score double",
    "student_deployments": "deployment_id string, student string, revision string, host string, gpu_indices array<int>, status string, endpoint string, created_at timestamp_ntz",
    "service_heartbeats": "worker_id string, service string, status string, version string, started_at timestamp_ntz, last_seen timestamp_ntz",
    "system_events": (
        "id long, ts timestamp_ntz, level string, service string, event string, payload string, message string, context string, trace_id string, "
        "rollout_id string, pair_id string, run_id string"
    ),
    "metrics_minutely": "ts_minute timestamp_ntz, metric string, labels string, value double",
    "audit_log": "id long, ts timestamp_ntz, actor string, action string, target string, payload string",
}

#: Business keys: what an upsert matches on.
KEYS = {
    "environments": ["env_name"],
    "tasks": ["env_name", "task_id"],
    "teachers": ["teacher_name"],
    "rollouts": ["env_name", "task_id", "teacher_name", "sample_idx"],
    "sampling_lists": ["list_name"],
    "sampling_progress": ["list_name", "env_name", "task_id", "teacher_name"],
    "pair_sets": ["pair_set_name"],
    "pairs": ["pair_id"],
    "student_submissions": ["student", "revision"],
    "anti_copy_results": ["student", "revision", "round_ts"],
    "student_scores": ["run_id", "student", "revision"],
    "student_pair_scores": ["run_id", "student", "revision", "pair_id"],
    "student_deployments": ["deployment_id"],
    "service_heartbeats": ["worker_id"],
    "metrics_minutely": ["ts_minute", "metric", "labels"],
}

CELL = ["env_name", "task_id", "teacher_name"]
LISTED_CELL = ["list_name", *CELL]

#: A published shard, one file for each cell.
SHARD = (
    "rollout_id string, env_name string, task_id long, teacher_name string, sample_idx long, seed long, temperature float, top_p float, reward double, "
    "status string, tokens_in long, tokens_out long, steps long, trajectory binary, trajectory_sha256 string, group_label string, created_at string"
)

#: A manifest line, keys in sorted order.
MANIFEST = (
    "attempts int, committed_at string, env_name string, list_name string, mature_at string, n_rollouts long, object_key string, object_uri string, "
    "reward_mean double, reward_std double, task_id int, task_idx long, teacher_name string"
)
PUBLIC_MANIFEST = MANIFEST.replace("reward_mean", "promoted_at string, reward_mean")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
