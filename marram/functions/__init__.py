"""Column builders: no function here touches a DataFrame."""
