"""Values that must equal the ones in use elsewhere for results to agree.

Fixed values: constants, names and formats, not logic.
"""

# Limits and constants.
STATE_MAX_LEN = 100
FEATURE_DAYS = 365
SESSION_DAYS = 180
REPEAT_CALL_DAYS = 7
REPEAT_CALL_PENALTY = -3
REPROCESS_DAYS = 2
CHANCE_OF_NO_ACTION = 0.1
EPSILON = 0.1
TRAIN_SHARE = 0.7
SPLIT_SHARES = (0.8, 0.2)
STATE_SAMPLE = 0.3
GAMMA = 0.99
N_STEP = 6
SENTINEL_LOGIT = -1000
TOKEN_SEPARATOR = "___"
NO_ACTION = "none"
SENTINEL_MEMBER = "0000000000|0000000000000000||"
SESSION_METRICS = ("call", "resolved")

# Action space of the two applications; the common actions belong to both.
ACTION_SPACE = {
    "common": {0: "none", 6: "orderstatus", 7: "outstandingbalance", 9: "creditcard"},
    "ivr": {
        1: "autorefill",
        2: "sms",
        3: "renewal",
        4: "schedulerefill",
        5: "refill",
        8: "address",
        10: "clinicalopportunity",
        11: "diabeteshold",
    },
    "spec-pat": {
        12: "osp_commpref",
        13: "osp_ob_newtherapy_eosl",
        14: "osp_ob_arop_eosl",
        15: "osp_newtherapy_eosl",
        16: "osp_arop_eosl",
        17: "osp_ob_refillrenewal_secure",
        18: "osp_refillrenewal_secure",
        19: "osp_smf",
        20: "osp_paymenthold",
        21: "osp_amauthold",
        22: "osp_outreachhold",
        23: "osp_copaysavingscoverage",
        24: "osp_claimshistory",
        25: "osp_tstfrxstatus",
        26: "osp_officebaseddurationconsent",
    },
}

# Id type by application.
APP_ID_TYPE = {"ivr": "cagm", "spec-pat": "cagm", "advocacy": "enterprise_id"}

# Labels of the report codes.
BEFORE_AFTER = {1: "before", 0: "after"}

# Parameters kept with the best runs.
RUN_PARAMETERS = (
    "lr",
    "train_batch_size",
    "grad_clip",
    "explore",
    "rollout_fragment_length",
    "seed",
    "n_step",
    "adam_epsilon",
    "target_network_update_freq",
    "replay_buffer_config/capacity",
)
