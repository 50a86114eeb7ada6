"""Relational operators: keep-first, membership, joins, filters, counts."""

from ledgerspark.operators.counts import (day_count, distinct_ids, frequency, month_guard,  # noqa: F401
                                          observed, top_n)
from ledgerspark.operators.dedup import SEQ, keep_first  # noqa: F401
from ledgerspark.operators.filters import (all_present, carry_over, discarded_invoiced,  # noqa: F401
                                           in_range, is_posted, non_zero, not_person_contact)
from ledgerspark.operators.joins import first_per_key, left_from_master, semi_join_on  # noqa: F401
from ledgerspark.operators.lookup import tag_names_from_table  # noqa: F401
from ledgerspark.operators.membership import member_of  # noqa: F401
