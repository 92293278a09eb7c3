"""Schemas of the telemetry data model, as DDL."""

#: One message of a device with all its readings. Minimum and Peak are double; is_fresh may be absent.
POWER = "struct<AmbTemp:double,Average:double,CpuAvgFreq:bigint,CpuMax:bigint,CpuPwrSavLim:bigint,CpuUtil:bigint,CpuWatts:bigint,GpuWatts:bigint,Minimum:double,Peak:double,Time:string,is_fresh:boolean>"
DATA = f"struct<Id:string,Average:double,Maximum:double,Minimum:double,Name:string,PowerDetail:array<{POWER}>>"
INVENTORY = "struct<cpu_count:bigint,socket_count:bigint,cpu_inventory:array<struct<model:string,speed:bigint,total_cores:bigint>>,memory_inventory:array<struct<memory_size:bigint,operating_freq:bigint,memory_device_type:string>>>"
IDENTITY = "device_id string, report_id string, created_at string, model string, tags string, report_type string, server_name string, error_reason string, location_id string, location_city string, location_name string, location_state string, location_country string, processor_vendor string, server_generation string, platform_customer_id string, application_customer_id string, metric_type string, status boolean"
GOLDEN = f"{IDENTITY}, data {DATA}, inventory_data {INVENTORY}"

#: Rows of the hot table.
READING = "metric_time timestamp, device_id string, platform_customer_id string, application_customer_id string, amb_temp double, avg_watts double, cpu_avg_freq bigint, cpu_max int, cpu_pwr_sav_lim int, cpu_util int, cpu_watts int, gpu_watts int, min_watts int, peak_watts int, status boolean, error_reason string"

#: Batch timing rows.
BATCH_METRICS = "batch_id bigint, timestamp timestamp, total_time double, merge_time double, row_count bigint"

#: A prediction with its health.
PREDICTION = "device_id string, metric_time timestamp, avg_metric_value double, prediction int, anomaly_score double, health_score double, health_status string"

#: Dedup keys of the lake and of the warehouse.
LAKE_KEY = ("device_id", "metric_time", "application_customer_id")
WAREHOUSE_KEY = ("platform_customer_id", "application_customer_id", "device_id", "metric_time", "metric_id")
