"""Column layouts shared by all modules."""

from __future__ import annotations

# Key names of a device message.
REQUIRED_KEYS = ("app", "id", "portnum", "dtimestamp", "values", "ptimestamp")
OPTIONAL_KEYS = ("dtype", "mtype", "desc", "com", "loc")
PORT_KEYS = ("value", "valid", "unit")

KEY_TYPES = {
    "app": "string",
    "id": "string",
    "portnum": "int",
    "dtimestamp": "bigint",
    "ptimestamp": "bigint",
    "dtype": "string",
    "mtype": "string",
    "desc": "string",
    "com": "string",
    "loc": "string",
}

# One port of a message. `value` keeps its JSON type; `extra` is the JSON text of the keys that
# have no column here, so that they can be forwarded and queried.
PORT = "struct<value:variant,valid:boolean,unit:string,extra:string>"

MESSAGE_COLUMNS = (
    "app", "id", "portnum", "dtimestamp", "ptimestamp", "values",
    "dtype", "mtype", "desc", "com", "loc", "extra",
)

# The fields the main store is read with.
MAIN_STORE_FIELDS = (
    "id", "portnum", "mtype", "dtype", "ptimestamp", "dtimestamp", "values", "desc",
)

MESSAGE = ", ".join(
    f"`{name}` array<{PORT}>" if name == "values" else f"`{name}` {KEY_TYPES.get(name, 'string')}"
    for name in MESSAGE_COLUMNS
)
