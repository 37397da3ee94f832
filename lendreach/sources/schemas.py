"""Schemas of the domain tables. Unknown columns fail on write."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DateType(),
          "t": T.TimestampNTZType(), "m": T.DecimalType(18, 2), "f": T.DoubleType()}


def _schema(spec: str) -> T.StructType:
    """``name:t`` items, where t is s, l, i, d, t (timestamp), m (money) or f (ratio)."""
    return T.StructType([T.StructField(n, _TYPES[t])
                         for n, t in (x.split(":") for x in spec.split())])


# what every list history holds
_LIST = ("business_date:d channel:s list_name:s job_id:s list_module:s list_frq:s lms_customer_id:l "
         "lms_application_id:l received_time:t lms_code:s state:s product:s loan_sequence:i email:s "
         "customer_firstname:s customer_lastname:s list_generation_time:t")

TABLES = {
    "leads_accepted": _schema(
        "lms_code:s lms_customer_id:l lms_application_id:l lead_sequence_id:l original_lead_id:l "
        "loan_number:s origination_loan_id:l received_time:t origination_time:t withdrawn_time:t "
        "last_paymentdate:d effective_date:d state:s product:s storename:s loan_sequence:i "
        "isreturning:i isexpress:i isuniqueaccept:i isoriginated:i isapplicationtest:i "
        "application_status:s loan_status:s withdrawn_reason_code:i withdrawn_reason:s "
        "emailaddress:s email_marketingoptin:i customer_firstname:s customer_lastname:s "
        "requested_amount:m approved_amount:m paycheck:m maxloanlimit:m pay_frequency:s "
        "campaign_name:s provider_name:s affid:s lead_cost:m"),
    "base_loans": _schema(
        "base_loan_id:l loan_header_id:l customer_id:l lms_entity_id:i loan_status:s is_paying:i "
        "paid_off_date:d due_date:d"),
    "payment_schedules": _schema(
        "payment_schedule_id:l base_loan_id:l customer_id:l is_active:i is_collections:i"),
    "payment_schedule_items": _schema(
        "payment_schedule_item_id:l payment_schedule_id:l item_date:d status:s payment_mode:s "
        "item_type:s total_amount:m amount_prin:m amount_fee:m amount_int:m"),
    "client_transactions": _schema(
        "base_loan_id:l trans_date:t trans_type:s amount:m principal_amount:m fee_amount:m"),
    "legacy_loans": _schema(
        "id:l original_loan_id:l debtor_client_id:l loan_status:s state:s due_date:d "
        "collection_start_date:d approved_amount:m approved_fee:m"),
    "legacy_payments": _schema(
        "loan_id:l effective_date:d is_debit:i payment_status:s payment_amount:m"),
    "loc_accounts": _schema(
        "acct_id:l account_number:s credit_limit:m current_balance:m principal:m amount_due:m "
        "date_of_total_due:d days_delinquent:i system_status:i is_after_holiday:i"),
    "loc_transactions": _schema(
        "account_number:l tran_type:s amount:m effective_date:d return_date:d payment_status:s "
        "is_collection:i"),
    "tracking": _schema(
        "id:l timestamp:t page:s user_name:s session_id:s lms_customer_id:l lead_sequence_id:l "
        "organization_id:i"),
    "user_application_info": _schema(
        "email:s organization_id:i firstname:s state:s amount:m"),
    "notifications": _schema(
        "customer_id:l notification_name_id:i state:i first_consent_date_time:t"),
    "notification_names": _schema("notification_name_mapping_id:i notification_name:s"),
    "sms_events": _schema(
        "event_id:l customer_id:l notification_name_id:i message:s event_date:t"),
    "customer_flat": _schema(
        "customer_id:l homephone:s cellphone:s payfrequency:s nmi:m paycheck_amount:m "
        "optout_account_email:s optout_marketing_email:s"),
    "customer_flags": _schema("cust_id:l flag_id:i flag_value:i"),
    "calendar": _schema(
        "ori_date:d weekend:i holiday:i operation_date:d pre_target_date:d post_target_date:d"),
    "business_holidays": _schema("holiday:d description:s"),
    "loan_limit_rates": _schema(
        "state_code:s product_code:s loan_sequence:i pay_frequency:s rpp:m hardcap:m min_amt:m"),
    "credit_limit_lookup": _schema(
        "entity_id:i pay_frequency:s effective_date:d maximum_limit:m"),
    "entity_parameters": _schema("lms_entity_id:i parameter_name:s value:s"),
    "loan_header_todo_list": _schema("loan_header_id:l todo_name:s completion_time:t"),
    "application": _schema(
        "lead_sequence_id:l insert_date:t email:s state:s affid:s decision:s decision_detail:s "
        "lead_provider_id:i lead_cost:m uw_cost:m nmi:s"),
    "dm_campaign_mapping": _schema(
        "mapping_id:i dm_name:s affid:s start_date:d expire_date:d data_provider:s unit_cost:m "
        "total_mail_count:l total_application:l"),
    "dm_application_log": _schema(
        "email:s state:s promo_code:s validation_date:t create_datetime:t application_status:i "
        "organization_id:i"),
    "campaign_history": _schema(
        "business_date:d channel:s list_name:s job_id:s list_module:s list_frq:s "
        "lms_customer_id:l lms_application_id:l received_time:t lms_code:s state:s product:s "
        "loan_sequence:i email:s customer_firstname:s customer_lastname:s requested_amount:m "
        "approved_amount:m max_loan_limit:m ach_date:d ach_debit:m list_generation_time:t "
        "ddr_type:s last_repayment_date:d withdrawn_time:t is_transactional_optin:i "
        "is_sms_marketing_optin:i home_phone:s cell_phone:s extra1:i key_word:s comments:s "
        "origination_time:t origination_loan_id:l original_loan_amount:m ach_finance:m ach_principal:m "
        "ach_interest:m original_fee:m number_of_installment:i rebate_amount:m fee_outstanding:m pif_amount:m "
        "next_loan_limit:m withdrawn_reason:s created_date:t hour_received:i promo_code:s dm_expire_date:d"),
    "campaign_history_monthly": _schema(
        f"{_LIST} requested_amount:m approved_amount:m max_loan_limit:m last_payment_date:d "
        "days_since_paid_off:i gc_group:s wait_group:s min_amt:m hardcap:m cell_phone:s next_loan_limit:m "
        "is_transactional_optin:i is_sms_marketing_optin:i comments:s"),
    "campaign_history_loc": _schema(
        f"{_LIST} requested_amount:m approved_amount:m credit_limit:m outstanding_balance:m "
        "available_credit_limit:m principal:m last_payment_date:d cell_phone:s is_transactional_optin:i "
        "is_sms_marketing_optin:i comments:s run_date:d first_name:s pay_frequency:s loan_status:s "
        "origination_date:d origination_loan_id:l total_draw_amount:m total_draw_count:l default_count:l "
        "collection_count:l total_balance:m principal_balance:m fee_balance:m max_loan_limit:m avail_credit_rate:f "
        "available_credit_range:s day_since_last_payment:i day_since_last_topup:i total_prin_paid:m last_draw_date:d "
        "total_default_count:l total_payment_count:l days_since_last_draw:i days_since_last_payment:i"),
    "campaign_history_esig": _schema(
        f"{_LIST} requested_amount:m approved_amount:m max_loan_limit:m is_dm:i is_originated:i "
        "todo_item_cnt:i incomplete_cnt:i is_esig_incomplete:i cell_phone:s is_transactional_optin:i "
        "is_sms_marketing_optin:i esig_wf:i bv_wf:i spouse_wf:i tnc_wf:i other_wf:i ref_wf:i emp_wf:i "
        "paystub_wf:i sms_consent:i no_bank_call:i routing_changed:i account_changed:i bv_final:s comments:s"),
    "campaign_list_test_email": _schema(
        "email_address:s first_name:s last_name:s request_loan_amount:m approved_amount:m "
        "comments:s is_active:i"),
    "delivery_statistics": _schema(
        "report_date:d category:s requests:l delivered:l unique_opens:l unique_clicks:l "
        "unsubscribes:l bounces:l spam_reports:l blocks:l"),
    "call_log": _schema("id:l called_ani:s call_start_time:t"),
}
