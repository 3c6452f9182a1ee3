"""churnwise: monthly subscriber analytics (opening/closing bases, movements,
churn, converged base, sales drivers, overdue funnel) as Spark DataFrame plans."""

from churnwise.params import RunParams

__all__ = ["RunParams"]
__version__ = "0.1.0"
