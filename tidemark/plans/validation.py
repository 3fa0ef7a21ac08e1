"""Quality rules of the gold tables."""

# --- Fixed values: columns and their rules, in the order of the reports ---
CAMPAIGN_RULES = [
    ("id", "no_nulos"),
    ("channel", "no_nulos"),
    ("started_at", "formato_fecha"),
    ("finished_at", "nulos_mayor_95"),
    ("subject_with_personalization", "validacion_boolean"),
    ("subject_with_deadline", "validacion_boolean"),
    ("subject_with_emoji", "validacion_boolean"),
    ("subject_with_bonuses", "validacion_boolean"),
    ("subject_with_discount", "validacion_boolean"),
    ("subject_with_saleout", "validacion_boolean"),
    ("warmup_mode", "validacion_boolean"),
]

CLIENT_RULES = [
    ("client_id", "no_nulos"),
    ("age", "edad_mayor_18"),
    ("average_purchase_value", "valores_positivos"),
    ("first_purchase_date", "formato_fecha"),
]

MESSAGE_RULES = [
    ("client_id", "no_nulos"),
    ("campaign_id", "no_nulos"),
    ("channel", "no_nulos"),
    ("platform", "no_nulos"),
    ("date", "formato_fecha"),
    ("opened_first_time_at", "nulos_mayor_95"),
    ("is_opened", "validacion_boolean"),
    ("is_clicked", "validacion_boolean"),
    ("is_unsubscribed", "validacion_boolean"),
    ("is_hard_bounced", "validacion_boolean"),
    ("is_soft_bounced", "validacion_boolean"),
    ("is_complained", "validacion_boolean"),
    ("is_blocked", "validacion_boolean"),
    ("is_purchased", "validacion_boolean"),
]
