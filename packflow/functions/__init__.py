"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from packflow.functions.exprs import *  # noqa: F401,F403
