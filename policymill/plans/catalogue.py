"""All queries of the core library by name, and their SQL."""

from policymill.plans import answers, loading, problems, reference

QUERIES = {**reference.QUERIES, **loading.QUERIES, **problems.QUERIES}
ORACLE = {**reference.ORACLE, **loading.ORACLE, **problems.ORACLE}
