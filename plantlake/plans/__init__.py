"""The tables of the lakehouse and the jobs that build them."""
