"""Names and constants that stored tables and their readers agree on."""

# ---------------------------------------------------------------------------
# Column names, statuses, messages and formats of the stored
# tables. Existing tables and dashboards use them, so they must not change.
# ---------------------------------------------------------------------------

# Control columns of the history and current tables.
RUN_ID = "key_log_file_path"
UPDATED_AT = "dt_atualizacao"
INGESTED_ON = "dt_ingestao"
SOURCE_NAME = "nm_arquivo_origem"
KEY_HASH = "hash_chave"
ROW_HASH = "hash_columns"

# Hash input and digest.
HASH_SEPARATOR = "||"
HASH_BITS = 256

#: Release of the history that a row came with; a folder name, not a stored column.
RELEASE = "tidemark_release"
# Columns of the landed snapshots that are not kept.
DROPPED_ON_READ: tuple[str, ...] = ()

# Folders of the layers below a common root.
STAGE_FOLDER = "1-stage"
HISTORY_FOLDER = "2-bronze"
CURRENT_FOLDER = "3-silver"
QUARANTINE_FOLDER = "4-quarantine"
INGEST_LOG_FOLDER = "5-logs/1-bronze"
REFRESH_LOG_FOLDER = "5-logs/2-silver"

# Run-log columns, in stored order.
INGEST_LOG_COLUMNS = (
    "id_log_file_path",
    "process_name",
    "start_time_script",
    "end_time_script",
    "start_create_session",
    "end_create_session",
    "input_path",
    "output_path",
    "start_reading_file",
    "end_reading_file",
    "start_add_control_columns",
    "end_add_control_columns",
    "start_merge_delta",
    "end_merge_delta",
    "records_processed",
    "status",
    "msg_erro",
)
REFRESH_LOG_COLUMNS = (
    "id_log_file_path",
    "process_name",
    "date_run",
    "start_time_script",
    "end_time_script",
    "status",
    "msg",
    "input_path",
    "output_path",
    "records_inserted",
    "records_updated",
    "start_bronze_reading",
    "end_bronze_reading",
    "start_filter_data",
    "end_filter_data",
    "start_filter_new_data",
    "end_filter_new_data",
    "start_transform_strings",
    "end_transform_strings",
    "start_add_column_log",
    "end_add_column_log",
    "start_update_delta_silver",
    "end_update_delta_silver",
)
LOG_ID = "id_log_file_path"
INGEST_PROCESS_PREFIX = "BRONZE_LOG_"
REFRESH_PROCESS_PREFIX = "SILVER_LOG_"

# Run statuses and messages.
STARTED = "STARTED"
SUCCEEDED = "SUCESSO"
SKIPPED = "IGNORADO"
FAILED = "ERRO"
REFRESH_SUCCEEDED_MESSAGE = "EXECUTADO COM SUCESSO"
REFRESH_FAILED_PREFIX = "MSG ERRO -> "

# Clock formats: Spark datetime patterns and the same for Python's strftime.
FILE_STAMP_PATTERN = "yyyyMMdd_HHmmss"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAY_PATTERN = "yyyy-MM-dd"
FILE_STAMP_STRFTIME = "%Y%m%d_%H%M%S"
SECOND_STRFTIME = "%Y-%m-%d %H:%M:%S"
DAY_STRFTIME = "%Y-%m-%d"

# ---------------------------------------------------------------------------
# Groups of the names above.
# ---------------------------------------------------------------------------
HASH_COLUMNS = (KEY_HASH, ROW_HASH)
RUN_COLUMNS = (RUN_ID, UPDATED_AT, INGESTED_ON, SOURCE_NAME)
CONTROL_COLUMNS = RUN_COLUMNS + HASH_COLUMNS
