"""DataFrame -> DataFrame operators of the detection flow."""
