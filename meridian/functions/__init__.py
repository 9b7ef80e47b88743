"""Column functions and the fixed tables behind them."""
