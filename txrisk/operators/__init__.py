"""DataFrame to DataFrame operators. They read no tables and run no actions, except
``calibration.exact_thresholds``, which counts rows before it returns its last step."""
