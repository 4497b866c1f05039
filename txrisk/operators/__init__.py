"""DataFrame -> DataFrame operators."""

from txrisk.operators.accounts import (  # noqa: F401
    customer_features, customer_profile, dest_frequency, dest_reuse_histogram,
    fraud_destinations, top_customers,
)
from txrisk.operators.filters import (  # noqa: F401
    risky, slice_domain, slice_summary, slice_tx, time_split, train_test,
)
from txrisk.operators.metrics import (  # noqa: F401
    auc_evaluator, auc_exact, compare_to_rule, confusion, confusion_cells, errors, prf,
    rule_baseline, score_histogram,
)
from txrisk.operators.profile import (  # noqa: F401
    activity_by_step, amount_histogram, fraud_rate_by_type, kpis, overview, rule_recall,
    split_summary, top_destinations, volume_by_type,
)
from txrisk.operators.balances import (  # noqa: F401
    mismatch_by_label, mismatch_long, reconcile, velocity_by_label,
)
from txrisk.operators.sampling import hash_sample, legit_sample, stratified_sample  # noqa: F401
from txrisk.operators.velocity import rolling_totals, with_velocity  # noqa: F401
