"""Values the results depend on.

Fixed values: states, limits, defaults, patterns and message formats. They are given by the tool
whose runs are modelled, by the launcher, the cluster managers and their services, so they must not
be changed. The limits are defaults of arguments.
"""

# Connection defaults.
DEFAULT_MASTER = "yarn"
DEFAULT_BINARY = "spark-submit"
NAMESPACE_CONF = "spark.kubernetes.namespace"

# Keys of a connection's extra settings.
EXTRA_QUEUE = "queue"
EXTRA_DEPLOY_MODE = "deploy-mode"
EXTRA_SPARK_HOME = "spark-home"
EXTRA_SPARK_BINARY = "spark-binary"
EXTRA_NAMESPACE = "namespace"

# Markers in a master address.
YARN_MARK = "yarn"
K8S_MARK = "k8s"
STANDALONE_MARK = "spark://"
REST_PORT_MARK = ":6066"
CLUSTER_MODE = "cluster"

# Driver states.
FINAL_STATES = ("FINISHED", "UNKNOWN", "KILLED", "FAILED", "ERROR")
GOOD_STATE = "FINISHED"
NO_STATE = "UNKNOWN"
MALFORMED_STATE = "MALFORMED"

# Limits.
TOLERATED_MISSES = 10
PAGE_ATTEMPTS = 11
HISTORY_ATTEMPTS = 30
HTTP_OK = 200

# Patterns in submit-log lines, with the cheap text each match must contain.
APPLICATION_TEXT = "application"
APPLICATION = r"(application[0-9_]+)"
APPLICATION_STRICT = r"(application_\d+_\d+)"
POD_TEXT = "pod name: "
POD = r"(?d)pod name: ((.+?)-([a-z0-9]+)-driver)"
EXIT_TEXT = "exit code: "
EXIT = r"exit code: (\d+)"
DRIVER_TEXT = "driver-"
DRIVER = r"(driver-[0-9\-]+)"

# Status reply.
STATE_TEXT = "driverState"
STATE_SEPARATOR = " : "
DRIVER_ENTRY = "driver"

# The 29 characters that count as whitespace at the ends of a line.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Secrets in a command line: the value between single quotes is hidden.
SECRET_VALUE = (
    r"(?iU)((?:secret|password)[^\s\x1c-\x1f]*?[\s\x1c-\x1f]*=[\s\x1c-\x1f]*')"
    r"[^']*+(?=')"
)
HIDDEN = "******"

# Log pages. A quoted value may hold a closing bracket; possessive runs keep long tags linear.
PRE_MARK = r"(?i)<pre(?:[\s/][^>]*)?>"
_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""
PAGE_PIECES = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(script|style)(?=[\s/>]){_ATTRIBUTES}.*?(?:</\1\s*>|\z)"
    rf"|</?[a-z]{_ATTRIBUTES}"
    r"|<[!?][^>]*>"
    r"|[^<]+|<"
)
# The same pieces up to the first block, for a page that may hide one in a comment, script or value.
PRE_AFTER_PIECES = (
    r"(?is)\A(?:<!--.*?(?:-->|\z)"
    rf"|<(script|style)(?=[\s/>]){_ATTRIBUTES}.*?(?:</\1\s*>|\z)"
    rf"|<(?!pre[\s/>])/?[a-z]{_ATTRIBUTES}"
    r"|<[!?][^>]*>"
    r"|[^<]++|<(?!pre[\s/>]))*+"
    rf"<pre(?=[\s/>]){_ATTRIBUTES}"
)
MAY_HIDE_MARKUP = r"""(?i)<!--|<script\b|<style\b|=\s*["']"""
TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
# A tag starts only before a letter, a declaration before ! or ?; any other bracket is text.
MARKUP = r"^<[/!?A-Za-z]."
REFERENCES = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&"
NUMBER_REFERENCE = r"^&#[xX]?[0-9a-fA-F]"
# Elements that have no content, in today's HTML and before; and those whose content is no markup.
VOID_ELEMENTS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)
RAW_ELEMENTS = ("script", "style")

# Chinese text in a pod log: from the first such character to the end of the line.
CJK_MARK = r"[\u4E00-\u9FA5]"
CJK_TEXT = r"(?d)[\u4E00-\u9FA5]+.*"

# Addresses and texts shown to people.
POLL_PATH = "/v1/submissions/status/"
SUBMIT_ERROR = "Cannot execute: %s. Error code is: %d."
NO_DRIVER_ERROR = (
    "No driver id is known: something went wrong when executing the spark submit command"
)
POLL_ERROR = "Failed to poll for the driver status %d times: returncode = %d"
DRIVER_ERROR = "ERROR : Driver %s badly exited with status %s"

# Run outcomes.
SUBMIT_FAILED = "SUBMIT_FAILED"
NO_DRIVER_ID = "NO_DRIVER_ID"
POLL_GAVE_UP = "POLL_GAVE_UP"
POLL_MALFORMED = "POLL_MALFORMED"
STILL_RUNNING = "STILL_RUNNING"
DRIVER_PREFIX = "DRIVER_"
SUCCESS = "SUCCESS"
