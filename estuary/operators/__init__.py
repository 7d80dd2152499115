"""Survey operators: DataFrame -> DataFrame functions, one module per stage."""
