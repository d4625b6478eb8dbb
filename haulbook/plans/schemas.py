"""The declared columns of every report: what a stored report holds, in order and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from haulbook.sources.sinks import write_report

_DDL = {
    "order_workflow":
        "placed date, order_id bigint, status string, status_name string, status_group string, priority string, "
        "site string, client string, ordered_by_name string, received timestamp_ntz, first_view timestamp_ntz, "
        "viewed_by_name string, time_to_view string, received_metric_met string, scheduled timestamp_ntz, "
        "scheduled_by_name string, time_to_schedule string, scheduling_metric_met string, scheduling_variance bigint, "
        "views_before bigint, last_view timestamp_ntz, reason_name string",
    "time_to_dispatch":
        "due date, order_id bigint, status string, status_name string, priority string, client string, site string, "
        "times_enroute bigint, dispatched_by string, minutes_to_dispatch bigint, scheduled timestamp_ntz, "
        "synced timestamp_ntz, variance string, add_on_stop boolean",
    "workflow_activity":
        "company_name string, order_id bigint, order_type string, patient string, stamp timestamp_ntz, "
        "viewed_at timestamp_ntz, viewed_by string, scheduled_at timestamp_ntz, scheduled_by string, "
        "assigned_at timestamp_ntz, assigned_by string, created_to_viewed string, scheduled_to_assigned string, "
        "viewed_to_scheduled string",
    "reconcile_log":
        "entry string, company_name string, client_name string, user string, user_full string, order_id bigint, "
        "reconciled_at timestamp_ntz, order_type string, reason string, warehouse string",
    "client_orders":
        "client_id int, patient_id bigint, order_id bigint, status string, type string, reason string, priority boolean, "
        "driver_id int, route_number int, ordered_by bigint, address_id bigint, dme_id int, stamp timestamp_ntz, "
        "price double, last_viewed timestamp_ntz, completed timestamp_ntz, schedule_end timestamp_ntz, "
        "scheduled timestamp_ntz, reconciled timestamp_ntz, completion_action int, last_viewed_by string, "
        "add_on_stop boolean, route_id bigint, service_call boolean, site_id int, last_name string, first_name string, "
        "patient string",
    "pickup_summary":
        "total_orders bigint, total_pickups bigint, pickups_within bigint",
    "orders_by_patient":
        "patient string, order_count bigint",
    "redelivery":
        "order_id bigint, patient_id bigint, driver_id int, route_number int, completed timestamp_ntz, reason string, "
        "window_start date, client_id int, site_id int, dme_count bigint, o2_count bigint, disposable_count bigint, "
        "service_count bigint, paired_count bigint, pickup_count bigint, fee_count bigint, note string, skipped bigint, "
        "pre_order_id bigint, pre_driver_id int, pre_route_number int, pre_completed timestamp_ntz, minutes bigint, "
        "redelivery int, in_period boolean",
    "paired_items":
        "order_id bigint, patient_id bigint, stop_day int, driver_id int, route_number int, sub_item int, out_day int, "
        "lines bigint, stop_count bigint, prior_count bigint, valid_on_stop int, found int, missed int",
    "redelivery_summary":
        "month string, window_start date, provider string, client string, region string, orders bigint, "
        "redeliveries bigint, missed_pairs bigint, n_24h bigint, n_48h bigint, n_72h bigint, n_96h bigint, n_120h bigint, "
        "n_144h bigint, n_168h bigint, pct_missed_pairs decimal(9,4), pct_redelivery decimal(9,4), pct_24h decimal(9,4), "
        "pct_48h decimal(9,4), pct_72h decimal(9,4), pct_96h decimal(9,4), pct_120h decimal(9,4), pct_144h decimal(9,4), "
        "pct_168h decimal(9,4)",
    "survey_review":
        "level int, client_company int, month string, region_id int, region_name string, client_name string, "
        "provider string, question string, meet decimal(9,6), fail decimal(9,6), exceed decimal(9,6)",
    "survey_quality_check":
        "month string, surveys_ever bigint, surveys_in_window bigint",
    "feedback_extract":
        "order_id bigint, type_name string, created timestamp_ntz, month string, feedback string, region string, "
        "client string",
    "escalations":
        "order_id bigint, type_name string, created timestamp_ntz, month string, feedback string, region string, "
        "client string",
    "driver_accuracy":
        "driver_id int, order_id bigint, completed_on date, site_id int, site_name string, serial_delivery bigint, "
        "oxygen_delivery bigint, serial_pickup bigint, oxygen_pickup bigint, ir_correct int, wo_match int, instruct int, "
        "dme int, signature int, notes int, replied int, driver_name string, missing_order_stat boolean, "
        "totally_accurate int",
    "inventory_past_due":
        "site_id bigint, site_name string, past_due bigint, tracked bigint, items bigint, pct_past_due decimal(9,2), "
        "pct_tracked decimal(5,2)",
    "service_call_details":
        "site_id int, site string, client string, completed timestamp_ntz, order_id bigint, driver string, "
        "ordered_by_name string, user_level string, reason_name string, place string, service_call string, beds string, "
        "concentrators string, lal string, wheelchairs string, other string, notes string",
    "service_call_orders":
        "client_name string, client_id int, order_id bigint, patient string, street string, city string, state string, "
        "zip string, reason_name string, ordered_on date, delivered_on date, notes string, note_parts bigint, "
        "product_name string, detail_id bigint",
    "service_level":
        "site_id int, address_id bigint, driver_id int, site_name string, client_id int, patient_id bigint, "
        "order_id bigint, status string, type string, reason string, priority boolean, route_number int, "
        "ordered_by bigint, dme_id int, stamp timestamp_ntz, price double, last_viewed timestamp_ntz, "
        "completed timestamp_ntz, schedule_end timestamp_ntz, scheduled timestamp_ntz, reconciled timestamp_ntz, "
        "completion_action int, last_viewed_by string, add_on_stop boolean, route_id bigint, service_call boolean, "
        "last_name string, patient string, disabled timestamp_ntz, torpid timestamp_ntz, dup int, phone1 string, "
        "phone2 string, contact string, infectious string, client_name string, region string, driver string, "
        "driver_user string, driver_phone string, driver_office_phone string, street string, city string, place string, "
        "street2 string, state string, zip string, latitude double, longitude double, room string, bed string, "
        "place_name string, zone string, zone_abbr string, variance bigint, missed int, status_group string, "
        "type_name string",
    "service_level_detail":
        "client_name string, order_id bigint, status string, status_group string, type string, stamp timestamp_ntz, "
        "scheduled_on string, completed timestamp_ntz, disabled timestamp_ntz, patient string, street string, "
        "street2 string, city string, state string, zip string, phone1 string, phone2 string, contact string, "
        "place string, submitter string, patient_id bigint, driver string, driver_id int, driver_user string, "
        "driver_phone string, driver_office_phone string, answer_id bigint, infectious string, latitude double, "
        "longitude double, room string, bed string, place_name string, completion_action int, route_id bigint, "
        "service_call boolean, note_count bigint, client_id int, site_id int, route_number int, add_on_stop string, "
        "last_viewed_by string, last_viewed timestamp_ntz, duplicate int, reason string, reason_name string, "
        "is_torpid int, is_disabled int, new_note int, site_name string, priority boolean, missed int, variance bigint, "
        "schedule_start timestamp_ntz, schedule_end timestamp_ntz, zone_abbr string, sequence_number int, "
        "specialty_count bigint, viewer_last string, viewer_first string",
    "order_channel":
        "hospice string, region_id int, region string, client string, provider string, site string, phone int, system int, "
        "phone_network int, phone_own int, order_id bigint, month string, ordered_by_name string",
    "census_average":
        "hospice int, region int, client int, site int, dme int, mean decimal(18,6), months bigint",
    "contract_pairs":
        "yyyymm int, client_id int, sub_unit int, site_id int, activity int, budget_id int, contract_id int, "
        "network_type string, owner int, contract_type string",
    "billable_items":
        "yyyymm int, client_id int, site_id int, item_id int, total decimal(19,4), records bigint, contract_type string, "
        "region_id int, region_name string",
    "top_items":
        "contract_type string, contract string, region_name string, item_id int, item_name string, item string, "
        "months_total decimal(38,4), m1_total decimal(38,4), m1_share decimal(18,3), m2_total decimal(38,4), "
        "m2_share decimal(18,3), m3_total decimal(38,4), m3_share decimal(18,3)",
}

REPORTS = list(_DDL)


def report_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join("`" + column.replace(" ", "` ", 1) for column in _DDL[name].split(", ")))


def store_report(df: DataFrame, name: str, path: str) -> str:
    """Replace the stored table of a report. A missing column, another type, or a value that does not fit its column is an error."""
    return write_report(df, path, report_schema(name))
