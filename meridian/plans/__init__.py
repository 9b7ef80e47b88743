"""Jobs, analytic plans and the registered queries."""
