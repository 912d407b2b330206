from .arithmetic import bit_and, bit_not, bit_or, bit_xor, concat_text, int_divide
from .compare import differs, same
from .convert import (ADD_ONE_DAY, EPOCH_MICROS, NUMBER_BYTES, convert_columns, enum_to_number, enum_to_text,
                      restore_columns)
from .defaults import is_type_default, type_default
from .names import quote
from .structs import flatten_columns, json_column, nest_columns, parent_key, parse_json_column, with_srid
from .times import round_timestamp, truncate_timestamp
