"""What the registered builds report of each stored table: the registered query of the same rows, and the column summed."""

BUILT = {
    "warehouse": {
        "latency_kpis_view": ("latency_kpis", "p95_latency_ms"),
        "dashboard_latency_hourly": ("latency_hourly", "p95_latency_ms"),
        "dashboard_latency_endpoint_rank_daily": ("latency_rank_daily", "p95_latency_ms"),
        "error_kpis_view": ("error_kpis", "rate_5xx"),
        "dashboard_errors_hourly": ("errors_hourly", "rate_5xx"),
        "dashboard_top_error_endpoints_daily": ("top_error_endpoints_daily", "rate_5xx"),
        "sla_kpis_view": ("sla_kpis", "sla_lt_500ms_rate"),
        "dashboard_sla_hourly": ("sla_hourly", "sla_lt_500ms_rate"),
        "dashboard_sla_daily": ("sla_daily", "sla_lt_500ms_rate"),
        "status_code_kpis_view": ("status_code_kpis", "total_requests"),
        "dashboard_status_codes_daily": ("status_codes_daily", "total_requests"),
        "dashboard_status_codes_hourly": ("status_codes_hourly", "total_requests"),
        "dashboard_status_families_daily": ("status_families_daily", "total_requests"),
        "dashboard_top_endpoints_per_error_code_daily": ("top_endpoints_per_error_code", "total_requests"),
        "dashboard_endpoint_degradation_daily": ("endpoint_degradation_daily", "p95_change_ratio"),
        "user_kpis_view": ("user_kpis", "avg_latency_ms"),
        "dashboard_user_activity_daily": ("user_activity_daily", "avg_latency_ms"),
        "dashboard_user_auth_errors_daily": ("user_auth_errors_daily", "auth_error_rate"),
        "dashboard_errors_rolling": ("errors_rolling", "rolling_rate_5xx_24h"),
        "dashboard_sla_rolling_drift": ("sla_rolling_drift", "rolling_sla_rate_500ms_1h"),
        "dashboard_user_rolling_activity": ("user_rolling_activity", "rolling_requests_1h"),
        "dashboard_anomaly_latency_zscore": ("anomaly_latency_zscore", "z_score"),
        "dashboard_anomaly_error_spikes": ("anomaly_error_spikes", "rate_diff"),
    },
    "local": {
        "dashboard_latency_daily": ("local_latency_daily", "avg_latency_ms"),
        "dashboard_errors_hourly": ("local_errors_hourly", "error_rate_5xx"),
        "dashboard_status_codes": ("local_status_codes", "total_requests"),
    },
}
