"""Plan helpers shared by the operators: staging, spreading and skew-safe joins."""
