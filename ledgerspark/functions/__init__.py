"""Scalar column normalisers: every function returns a Catalyst ``Column``."""

from ledgerspark.functions.dates import (day_text, iso_datetime, month_of, parse_date,  # noqa: F401
                                         parse_timestamp)
from ledgerspark.functions.numbers import amount, round_half_even, to_id  # noqa: F401
from ledgerspark.functions.relations import (exception_label, list_length, m2m_names,  # noqa: F401
                                             m2o_id, m2o_list_id, m2o_list_name, m2o_name,
                                             tag_names)
from ledgerspark.functions.text import (clean_markers, clean_strip, id_text, street_key,  # noqa: F401
                                        strip_doc_code, strip_ws)
