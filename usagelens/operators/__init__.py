"""Analytics operators: lazy DataFrame -> DataFrame functions."""
