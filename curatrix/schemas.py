"""Explicit schemas of documents that go in and out. Open objects (metadata) are variants; branch fields of logs are nullable."""

PROBLEM = "problem_id string, problem string, solution string, metadata variant"
REQUEST_LINE = "custom_id string, method string, url string, body struct<model: string, messages: array<struct<role: string, content: string>>, reasoning_effort: string>"
RESPONSE_LINE = "custom_id string, response struct<status_code: int, body: struct<choices: array<struct<message: struct<content: string>>>>>"
JOB_STATUS = "id string, status string, created_at long, completed_at long, failed_at long, request_counts struct<total: long, completed: long, failed: long>, output_file_id string, error_file_id string, errors string"
COMPILATION = "struct<success: boolean, duration_seconds: double, output: string>"
PARSABILITY = "struct<is_parsable: boolean, step_count: long>"
BATCH_INFO = "batch_id string, input_file string, created_at string, problem_count long"
STATS = ("total", "successful", "skipped", "failed_compilation", "failed_parsable", "failed_api")
